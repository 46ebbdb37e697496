"""Signals, Gold scoring and the expectations library."""

import datetime as dt
import json

import pytest
from helpers import RUN
from hypothesis import given, settings
from hypothesis import strategies as st

from cvelake.functions.columns import risk_score, risk_tier
from cvelake.operators.quality import Expectation, ExpectationFailed, apply_expectations, enforce, expectation_metrics
from cvelake.plans import gold as gd
from cvelake.plans import silver as sv
from cvelake.schemas import BRONZE_EPSS, BRONZE_JSON
from pyspark.sql import functions as F


def _ts(x):
    return dt.datetime.fromisoformat(x)


def test_signals_full_outer_and_flags(spark):
    epss = spark.createDataFrame([
        ("CVE-1-1", 0.2, 0.5, _ts(RUN), "epss_2024-01-16.csv", dt.date(2024, 1, 16)),
        ("CVE-1-2", 1.5, 0.9, _ts(RUN), "epss_2024-01-16.csv", dt.date(2024, 1, 16)),
        ("CVE-1-4", None, None, _ts(RUN), "epss_2024-01-16.csv", dt.date(2024, 1, 16)),
    ], BRONZE_EPSS)
    kev_json = [json.dumps({"cveID": c, "dateAdded": d, "dueDate": "2024-02-01",
                            "knownRansomwareCampaignUse": "Known", "notes": "n"}) for c, d in
                (("CVE-1-2", "2024-01-10"), ("CVE-1-3", "bad-date"))]
    kev = spark.createDataFrame([
        (c, j, _ts(RUN), "cisa_kev_2024-01-16.json", dt.date(2024, 1, 16))
        for c, j in zip(("CVE-1-2", "CVE-1-3"), kev_json)
    ], BRONZE_JSON)
    rec = sv.cve_signals_records(epss, kev)
    got = {r["cve_id"]: r for r in rec.collect()}
    assert set(got) == {"CVE-1-1", "CVE-1-2", "CVE-1-3", "CVE-1-4"}  # EPSS keys union KEV keys
    assert got["CVE-1-1"]["kev_flag"] is False and got["CVE-1-2"]["kev_flag"] is True
    assert got["CVE-1-3"]["kev_date_added"] is None and got["CVE-1-3"]["epss_score"] is None
    m = {r["rule"]: r for r in expectation_metrics(rec, sv.SIGNALS_RULES, "cve_signals", RUN).collect()}
    assert m["valid_epss_range"]["failed"] == 1  # 1.5 fails, NULL passes
    assert sv.cve_signals(epss, kev).count() == 4  # warn only


@pytest.mark.parametrize("kev,epss,cvss,score,tier", [
    (True, None, None, 90.0, "CRITICAL"),
    (False, 0.1, 5.0, 20.0, "LOW"),
    (False, 0.5, 5.0, 65.0, "MEDIUM"),
    (False, 1.0, None, 90.0, "CRITICAL"),
    (False, None, 10.0, 40.0, "MEDIUM"),
    (False, None, None, 0.0, "LOW"),
])
def test_risk_score_bands(spark, kev, epss, cvss, score, tier):
    df = spark.createDataFrame([(kev, epss, cvss)], "k boolean, e double, c double")
    r = df.select(risk_score(F.col("k"), F.col("e"), F.col("c")).alias("s")).select("s", risk_tier(F.col("s")).alias("t")).first()
    assert r["s"] == pytest.approx(score) and r["t"] == tier


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.one_of(st.none(), st.floats(0, 1)),
                          st.one_of(st.none(), st.floats(0, 10))), min_size=1, max_size=20))
def test_score_bounds_and_tier_consistency(spark, rows):
    df = spark.createDataFrame(rows, "k boolean, e double, c double")
    out = df.select(risk_score(F.col("k"), F.col("e"), F.col("c")).alias("risk_score"))
    out = out.withColumn("risk_tier", risk_tier(F.col("risk_score")))
    m = {r["rule"]: r for r in expectation_metrics(out, gd.GOLD_RULES, "g", RUN).collect()}
    assert m["risk_score_in_range"]["failed"] == 0 and m["risk_tier_matches_score"]["failed"] == 0


def test_primary_vendor_tie_goes_to_lowest(spark):
    p = spark.createDataFrame([
        ("C1", "u1", "zeta", "p1", None), ("C1", "u2", "alpha", "p2", None),
        ("C1", "u3", "zeta", None, None), ("C2", "u4", "beta", None, None),
    ], "cve_id string, cpe_uri string, vendor string, product string, version string")
    got = {r["cve_id"]: (r["primary_vendor"], r["primary_product"]) for r in gd.primary_products(p).collect()}
    assert got == {"C1": ("zeta", "p1"), "C2": ("beta", None)}


def test_expectation_actions(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    rules = [Expectation("warn_pos", "x > 1"), Expectation("not_null", "x IS NOT NULL", "drop")]
    assert apply_expectations(df, rules).count() == 2
    m = {r["rule"]: r for r in expectation_metrics(df, rules, "t", RUN).collect()}
    assert (m["warn_pos"]["passed"], m["warn_pos"]["failed"], m["warn_pos"]["dropped"]) == (1, 2, 0)
    assert (m["not_null"]["failed"], m["not_null"]["dropped"]) == (1, 1)
    assert all(r["total"] == 3 for r in m.values())  # every rule counted on the full input
    with pytest.raises(ExpectationFailed):
        enforce(expectation_metrics(df, [Expectation("must", "x IS NOT NULL", "fail")], "t", RUN))
    with pytest.raises(ValueError):
        Expectation("bad", "x", "explode")


def test_counts_taken_on_a_write_equal_those_of_a_scan(spark, tmp):
    from cvelake.operators.quality import counted, counted_metrics
    from cvelake.plans import silver as plans

    rules = [Expectation("some", "x IS NOT NULL"), Expectation("small", "x < 50", "drop"), Expectation("even", "x % 2 = 0", "fail")]
    df = spark.range(300).selectExpr("if(id % 7 = 0, null, id) AS x").repartition(5)
    for n, frame in enumerate((df, df.filter("x < 0"), spark.createDataFrame([], "x long"))):
        seen, counts = counted(frame, rules, "t")
        apply_expectations(seen, rules).write.parquet(f"{tmp}/{n}")
        got = counted_metrics(spark, counts, rules, "t", RUN)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expectation_metrics(frame, rules, "t", RUN).collect()))
        assert spark.read.parquet(f"{tmp}/{n}").count() == apply_expectations(frame, rules).count()

    from cvelake.sources import fixtures as fx

    bronze = [f(spark, "/root/testdata/sf0.001") for f in (fx.bronze_nvd, fx.bronze_epss, fx.bronze_kev)]
    written = plans.record_metrics(plans.silver_records(*bronze, staged=True), RUN)
    assert "FileScan" not in written._jdf.queryExecution().executedPlan().toString()  # no scan of the records
    scanned = plans.record_metrics(plans.silver_records(*bronze), RUN)
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, scanned.collect()))
