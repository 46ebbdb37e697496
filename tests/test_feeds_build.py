"""Feed files on disk -> Bronze, validation of broken files, the build job."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from cvelake.operators.quality import ExpectationFailed
from cvelake.plans import build
from cvelake.sources import feeds

from helpers import nvd_item

RUN1, RUN2 = "2024-01-15 06:00:00", "2024-01-16 06:00:00"


def _nvd_file(path, items, declared=None):
    env = {"CVE_data_type": "CVE", "CVE_data_numberOfCVEs": len(items) if declared is None else declared,
           "CVE_Items": [json.loads(i) for i in items]}
    with gzip.open(path, "wt", encoding="utf-8") as f:
        json.dump(env, f, indent=1)  # multi-line on purpose


def _feeds(root):
    for d in ("nvd", "kev", "epss"):
        os.makedirs(f"{root}/{d}", exist_ok=True)
    legacy = json.dumps({"cve": {"CVE_data_meta": {"ID": "CVE-2019-0001"}}})
    no_id = json.dumps({"cve": {"descriptions": []}})
    _nvd_file(f"{root}/nvd/nvd_modified_2024-01-15.json.gz",
              [nvd_item("CVE-2024-0001", v31=5.0), nvd_item("CVE-2024-0002"), legacy, no_id])
    _nvd_file(f"{root}/nvd/nvd_modified_2024-01-16.json.gz", [nvd_item("CVE-2024-0001", v31=9.8)], declared=3)
    with open(f"{root}/nvd/nvd_modified_2024-01-17.json.gz", "wb") as f:
        f.write(b"this is not gzip")
    _nvd_file(f"{root}/nvd/nvd_nodate.json.gz", [nvd_item("CVE-2024-0003")])
    with open(f"{root}/kev/cisa_kev_2024-01-15.json", "w") as f:
        json.dump({"vulnerabilities": [{"cveID": "CVE-2024-0002", "dateAdded": "2024-01-10", "dueDate": "2024-01-31",
                                        "knownRansomwareCampaignUse": "Known", "notes": ""}]}, f)
    with open(f"{root}/kev/cisa_kev_2024-01-16.json", "w") as f:
        json.dump({"vulns": []}, f)  # wrong envelope key
    with open(f"{root}/epss/epss_2024-01-15.csv", "w") as f:
        f.write("#model_version:v2023.03.01,score_date:2024-01-15T00:00:00+0000\n"
                "cve,epss,percentile\nCVE-2024-0001,0.9,0.99\n\nCVE-2024-0002,n/a,0.5\n")
    with open(f"{root}/epss/epss_2024-01-16.csv", "w") as f:
        f.write("id,score\nfoo,bar\n")  # wrong header


def test_readers(spark, tmp):
    _feeds(tmp)
    nvd = feeds.read_nvd(spark, f"{tmp}/nvd", RUN1).collect()
    ids = sorted(r["cve_id"] for r in nvd)
    assert ids == ["CVE-2019-0001", "CVE-2024-0001", "CVE-2024-0001", "CVE-2024-0002", "CVE-2024-0003"]
    dates = {(r["cve_id"], str(r["snapshot_date"])) for r in nvd}
    assert ("CVE-2024-0003", "None") in dates and ("CVE-2024-0001", "2024-01-16") in dates
    kev = feeds.read_kev(spark, f"{tmp}/kev", RUN1).collect()
    assert [r["cve_id"] for r in kev] == ["CVE-2024-0002"]
    epss = {r["cve_id"]: r for r in feeds.read_epss(spark, f"{tmp}/epss", RUN1, "epss_2024-01-15.csv").collect()}
    assert epss["CVE-2024-0001"]["epss_score"] == 0.9 and epss["CVE-2024-0002"]["epss_score"] is None


def test_epss_columns_are_found_by_name_and_dates_in_file_names_only(spark, tmp):
    folder = f"{tmp}/2023-05-05/epss"
    os.makedirs(f"{folder}/deeper")
    with open(f"{folder}/scores.csv", "w") as f:
        f.write("# c\n\n percentile ,EPSS,cve\n0.5,0.25,CVE-2024-0001\n,,CVE-2024-0002\n")
    with open(f"{folder}/epss_2024-02-02.csv", "w") as f:
        f.write("cve,epss,percentile\nCVE-2024-0003,1,0\n")
    with open(f"{folder}/deeper/epss_2024-02-03.csv", "w") as f:
        f.write("cve,epss,percentile\nCVE-2024-0009,1,0\n")
    want = [("CVE-2024-0001", 0.25, 0.5, "None"), ("CVE-2024-0002", None, None, "None"), ("CVE-2024-0003", 1.0, 0.0, "2024-02-02")]
    whole = feeds.bronze_of(feeds.feed_lines(spark.read, folder, "*.csv"), "epss", RUN1)
    for df in (feeds.read_epss(spark, folder, RUN1), whole):
        got = sorted((r["cve_id"], r["epss_score"], r["epss_percentile"], str(r["snapshot_date"])) for r in df.collect())
        assert got == want


def test_ingest_report_names_skipped_files(spark, tmp):
    _feeds(tmp)
    got = {(r["kind"], r["source_file"], r["reason"]) for r in feeds.ingest_report(spark, tmp).collect()}
    assert got == {
        ("nvd", "nvd_modified_2024-01-17.json.gz", "unreadable"),
        ("kev", "cisa_kev_2024-01-16.json", "missing or non-list 'vulnerabilities'"),
        ("epss", "epss_2024-01-16.csv", "header lacks cve, epss or percentile"),
    }


def test_validation_reports_broken_files(spark, tmp):
    _feeds(tmp)
    v = {os.path.basename(r["file_path"]): r for r in
         feeds.validate_files(spark, f"{tmp}/nvd", "nvd").unionByName(
             feeds.validate_files(spark, f"{tmp}/kev", "kev")).unionByName(
             feeds.validate_files(spark, f"{tmp}/epss", "epss")).collect()}
    assert v["nvd_modified_2024-01-15.json.gz"]["ok"] and v["nvd_modified_2024-01-15.json.gz"]["n_records"] == 4
    assert v["nvd_modified_2024-01-16.json.gz"]["ok"] and not v["nvd_modified_2024-01-16.json.gz"]["count_matches"]
    assert v["nvd_modified_2024-01-17.json.gz"]["reason"] == "unreadable"
    assert not v["cisa_kev_2024-01-16.json"]["ok"]
    assert v["cisa_kev_2024-01-15.json"]["n_records"] == 1
    assert v["epss_2024-01-16.csv"]["reason"] == "header lacks cve, epss or percentile"
    # comment and blank lines are skipped, as the reader skips them
    assert v["epss_2024-01-15.csv"]["ok"] and v["epss_2024-01-15.csv"]["n_records"] == 2


def test_build_runs_and_change_feed(spark, tmp):
    feed = f"{tmp}/feed"
    _feeds(feed)
    root = f"{tmp}/tables"
    g = {"nvd": "*.json.gz", "kev": "cisa_kev_2024-01-15.json", "epss": "epss_2024-01-15.csv"}
    summary = {(r["source"], r["snapshot_date"]): r["records"] for r in build.ingest(spark, root, feed, RUN1, g).collect()}
    assert summary[(None, None)] == 5 + 1 + 2
    build.build_run(spark, root, "r1", RUN1, "2024-03-01")
    # a new snapshot lands before run 2: one CVE changes, one is new
    _nvd_file(f"{feed}/nvd/nvd_modified_2024-01-18.json.gz",
              [nvd_item("CVE-2024-0002", v31=4.4), nvd_item("CVE-2024-0004")])
    build.ingest(spark, root, feed, RUN2, g)  # re-reads the folder: appends again
    build.build_run(spark, root, "r2", RUN2, "2024-03-01", previous_run_id="r1", buckets=4)
    core = {r["cve_id"]: r for r in spark.read.parquet(build.silver_path(root, "r2", "cve_core")).collect()}
    assert core["CVE-2024-0001"]["cvss_v3_score"] == 9.8 and core["CVE-2024-0002"]["cvss_v3_score"] == 4.4
    changes = {(r["cve_id"], r["_change_type"]) for r in
               spark.read.parquet(f"{root}/silver/cve_documents_changes").collect()}
    assert changes == {("CVE-2024-0002", "update_preimage"), ("CVE-2024-0002", "update_postimage"),
                       ("CVE-2024-0004", "insert")}
    hist = build.quality_history(spark, root)
    assert hist.select("run").distinct().count() == 2
    assert hist.first()["run"] == "r2"  # newest run first
    enriched = spark.read.parquet(f"{root}/gold/run=r2/vuln_enriched").collect()
    assert {r["cve_id"] for r in enriched} == {"CVE-2024-0001", "CVE-2024-0002", "CVE-2024-0003", "CVE-2024-0004"}
    dbs = {r[0] for r in build.create_schemas(spark).collect()}
    assert {"bronze", "silver", "gold", "agent"} <= dbs
    names = build.register_run(spark, root, "r2")
    assert spark.table("silver.cve_core").count() == len(core) and "gold.vendor_risk_agg" in names
    comment = [r for r in spark.sql("DESCRIBE TABLE EXTENDED silver.cve_core").collect() if r[0] == "Comment"]
    assert comment and "latest record per CVE" in comment[0][1]


def test_fail_rule_stops_before_write(spark, tmp):
    from cvelake.operators import quality as q

    df = spark.createDataFrame([(None,)], "cve_id string")
    with pytest.raises(ExpectationFailed):
        q.enforce(q.expectation_metrics(df, [q.Expectation("id", "cve_id IS NOT NULL", "fail")], "t", RUN1))


def test_month_partitions_prune_and_csv_export(spark, tmp):
    import datetime as dt

    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [("C1", dt.datetime(2024, 1, 5)), ("C2", dt.datetime(2024, 2, 5)), ("C3", dt.datetime(2023, 12, 1))],
        "cve_id string, published timestamp")
    build.write_by_month(df, f"{tmp}/m")
    r = spark.read.parquet(f"{tmp}/m").filter((F.col("year") == 2024) & (F.col("month") == 2))
    assert [x["cve_id"] for x in r.collect()] == ["C2"]
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan
    build.export_csv(df.select("cve_id"), f"{tmp}/csv")
    back = spark.read.option("header", True).csv(f"{tmp}/csv")
    assert sorted(x["cve_id"] for x in back.collect()) == ["C1", "C2", "C3"]


def test_bucketed_silver_joins_without_shuffle(spark, tmp):
    import re

    from cvelake.plans import gold as gd
    from cvelake.queries import silver

    s = silver(spark, "/root/testdata/sf0.001")
    b = build.bucketed_silver(spark, s, tmp, "2024-01-16", 8)  # a date-style run id
    e = gd.vuln_enriched(b.core, b.signals, b.products)
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(cve_id", plan)
    want = gd.vuln_enriched(s.core, s.signals, s.products)
    assert sorted(map(tuple, e.collect())) == sorted(map(tuple, want.collect()))


def test_a_bucketed_table_has_a_file_for_each_bucket(spark, tmp):
    df = spark.range(5000).select(F.concat(F.lit("CVE-"), F.col("id").cast("string")).alias("cve_id")).repartition(7)
    build.save_bucketed(df, "files_of_buckets", f"{tmp}/b", 6)
    try:
        assert len([f for f in os.listdir(f"{tmp}/b") if f.endswith(".parquet")]) == 6
        assert spark.table("files_of_buckets").count() == 5000
    finally:
        spark.sql("DROP TABLE files_of_buckets")
