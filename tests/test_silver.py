"""Silver semantics on hand-made Bronze rows (one case per documented edge)."""

import json

from helpers import RUN, bronze_rows, cpe, nvd_item

from cvelake.plans import silver as sv
from cvelake.schemas import BRONZE_EPSS, BRONZE_JSON

F1, F2 = "nvd_modified_2024-01-15.json.gz", "nvd_modified_2024-01-16.json.gz"
D1, D2 = "2024-01-15", "2024-01-16"
LONG = "A sufficiently long English description of the flaw."


def _core(spark, rows):
    return {r["cve_id"]: r for r in sv.cve_core(bronze_rows(spark, rows)).collect()}


def test_newer_snapshot_wins_within_one_run(spark):
    rows = [
        ("CVE-2024-0001", nvd_item("CVE-2024-0001", v31=5.0), RUN, F1, D1),
        ("CVE-2024-0001", nvd_item("CVE-2024-0001", v31=7.5), RUN, F2, D2),
    ]
    assert _core(spark, rows)["CVE-2024-0001"]["cvss_v3_score"] == 7.5


def test_later_run_wins_over_snapshot_date(spark):
    rows = [
        ("CVE-2024-0001", nvd_item("CVE-2024-0001", v31=7.5), "2024-01-15 06:00:00", F2, D2),
        ("CVE-2024-0001", nvd_item("CVE-2024-0001", v31=5.0), RUN, F1, D1),
    ]
    assert _core(spark, rows)["CVE-2024-0001"]["cvss_v3_score"] == 5.0


def test_dedup_runs_before_description_drop(spark):
    rows = [
        ("CVE-2024-0002", nvd_item("CVE-2024-0002"), RUN, F1, D1),
        ("CVE-2024-0002", nvd_item("CVE-2024-0002", desc=(("fr", "texte"),)), RUN, F2, D2),
    ]
    assert "CVE-2024-0002" not in _core(spark, rows)


def test_cvss_fallbacks_and_empty_arrays(spark):
    rows = [
        ("CVE-2024-0003", nvd_item("CVE-2024-0003", v30=6.1, empty_v31=True), RUN, F1, D1),
        ("CVE-2024-0004", nvd_item("CVE-2024-0004", v2=5.0), RUN, F1, D1),
        ("CVE-2024-0005", nvd_item("CVE-2024-0005", weaknesses=[]), RUN, F1, D1),
    ]
    c = _core(spark, rows)
    assert (c["CVE-2024-0003"]["cvss_v3_score"], c["CVE-2024-0003"]["cvss_v3_severity"]) == (6.1, "MEDIUM")
    assert c["CVE-2024-0004"]["cvss_v3_score"] is None and c["CVE-2024-0004"]["cvss_v2_score"] == 5.0
    assert c["CVE-2024-0005"]["cwe_id"] is None


def test_weakness_without_description_nulls_cwe(spark):
    w_ok = {"description": [{"lang": "en", "value": "CWE-79"}]}
    rows = [
        ("CVE-2024-0006", nvd_item("CVE-2024-0006", weaknesses=[w_ok]), RUN, F1, D1),
        ("CVE-2024-0007", nvd_item("CVE-2024-0007", weaknesses=[w_ok, {"source": "x"}]), RUN, F1, D1),
    ]
    c = _core(spark, rows)
    assert c["CVE-2024-0006"]["cwe_id"] == "CWE-79"
    assert c["CVE-2024-0007"]["cwe_id"] is None


def test_legacy_malformed_and_bad_timestamp(spark):
    legacy = json.dumps({"cve": {"CVE_data_meta": {"ID": "CVE-2019-0001"}}})
    rows = [
        ("CVE-2019-0001", legacy, RUN, F1, D1),
        ("cve-2024-1", nvd_item("cve-2024-1"), RUN, F1, D1),
        ("CVE-2024-0008", nvd_item("CVE-2024-0008", modified="nope"), RUN, F1, D1),
    ]
    c = _core(spark, rows)
    assert "CVE-2019-0001" not in c  # legacy layout: no description in the 2.0 schema
    assert "cve-2024-1" in c  # warn rule: kept
    assert c["CVE-2024-0008"]["last_modified"] is None


def test_affected_products_rules(spark):
    cpes = [
        cpe("cpe:2.3:a:apache:http_server:2.4.1:*:*:*:*:*:*:*"),
        cpe("cpe:2.3:a:apache:http_server:2.4.1:*:*:*:*:*:*:*"),  # same CPE twice
        cpe("cpe:2.3:a:*:thing:1:*:*:*:*:*:*:*"),  # wildcard vendor: dropped
        cpe("cpe:2.3:a:acme:-:*:*:*:*:*:*:*:*"),  # product/version sentinels -> NULL
        cpe("cpe:2.3:a:ven\\:dor:prod:1:*:*:*:*:*:*:*"),  # escaped colon: naive split
        cpe("cpe:2.3:a:off:x:1:*:*:*:*:*:*:*", vulnerable=False),
        cpe("cpe:2.3:a:nul:x:1:*:*:*:*:*:*:*", vulnerable=None),
        cpe("cpe:2.3"),  # short URI: no vendor, dropped
    ]
    rows = [("CVE-2024-0009", nvd_item("CVE-2024-0009", cpes=cpes), RUN, F1, D1)]
    p = sv.cve_affected_products(bronze_rows(spark, rows)).collect()
    got = sorted((r["vendor"], r["product"], r["version"]) for r in p)
    assert got == [("acme", None, None), ("apache", "http_server", "2.4.1"), ("ven\\", "dor", "prod")]


def test_documents_text_and_labels(spark):
    rows = [
        ("CVE-2024-0010", nvd_item("CVE-2024-0010", cpes=[cpe("cpe:2.3:a:acme:-:1:*:*:*:*:*:*:*")],
                                   weaknesses=[{"description": [{"lang": "en", "value": "CWE-20"}]}]), RUN, F1, D1),
        ("CVE-2024-0011", nvd_item("CVE-2024-0011"), RUN, F1, D1),
        ("CVE-2024-0012", nvd_item("CVE-2024-0012", desc=(("en", "x" * 50),)), RUN, F1, D1),
        ("CVE-2024-0013", nvd_item("CVE-2024-0013", desc=(("en", "x" * 51),)), RUN, F1, D1),
    ]
    b = bronze_rows(spark, rows)
    no_epss = spark.createDataFrame([], BRONZE_EPSS)
    no_kev = spark.createDataFrame([], BRONZE_JSON)
    s = sv.silver_tables(b, no_epss, no_kev)
    d = {r["cve_id"]: r for r in s.documents.collect()}
    assert d["CVE-2024-0010"]["document_text"] == LONG + " | Affected vendors: acme | Weakness: CWE-20"
    assert d["CVE-2024-0010"]["products_str"] == ""
    assert d["CVE-2024-0011"]["vendors_str"] is None and d["CVE-2024-0011"]["document_text"] == LONG
    assert "CVE-2024-0012" not in d and "CVE-2024-0013" in d
    assert d["CVE-2024-0011"]["kev_flag"] is False


def test_dedup_keys_unique_and_metrics_balance(spark):
    from cvelake.queries import _bronze

    nvd, epss, kev = _bronze(spark, "/root/testdata/sf0.001")
    core = sv.cve_core(nvd)
    assert core.count() == core.select("cve_id").distinct().count()
    m = {r["rule"]: r for r in sv.silver_metrics(nvd, epss, kev, RUN).filter("table = 'cve_core'").collect()}
    records = sv.cve_core_records(sv.parse_nvd(nvd)).count()
    assert m["has_description"]["total"] == records
    assert records - m["has_description"]["dropped"] == core.count()


def test_same_key_twice_in_one_file_has_a_fixed_winner(spark):
    rows = [
        ("CVE-2024-0020", nvd_item("CVE-2024-0020", v31=3.0), RUN, F1, D1),
        ("CVE-2024-0020", nvd_item("CVE-2024-0020", v31=8.0), RUN, F1, D1),
    ]
    b = bronze_rows(spark, rows)
    winners = {
        sv.cve_core(x).first()["cvss_v3_score"]
        for x in (b, b.repartition(2), b.orderBy("raw_json"), b.orderBy(b["raw_json"].desc()))
    }
    assert len(winners) == 1
