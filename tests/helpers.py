"""Hand-made Bronze rows for edge-case tests."""

import json

RUN = "2024-01-16 06:00:00"


def nvd_item(cve_id, desc=(("en", "A sufficiently long English description of the flaw."),), v31=None, v30=None,
             v2=None, weaknesses=None, cpes=None, published="2024-01-02T10:00:00.000", modified="2024-01-03T10:00:00.000",
             empty_v31=False):
    cve = {"id": cve_id, "published": published, "lastModified": modified,
           "descriptions": [{"lang": l, "value": v} for l, v in desc]}
    m = {}
    if v31 is not None:
        m["cvssMetricV31"] = [{"cvssData": {"baseScore": v31, "baseSeverity": "HIGH", "vectorString": "CVSS:3.1/X"}}]
    elif empty_v31:
        m["cvssMetricV31"] = []
    if v30 is not None:
        m["cvssMetricV30"] = [{"cvssData": {"baseScore": v30, "baseSeverity": "MEDIUM", "vectorString": "CVSS:3.0/X"}}]
    if v2 is not None:
        m["cvssMetricV2"] = [{"cvssData": {"baseScore": v2, "vectorString": "AV:N"}}]
    cve["metrics"] = m
    if weaknesses is not None:
        cve["weaknesses"] = weaknesses
    if cpes is not None:
        cve["configurations"] = [{"nodes": [{"operator": "OR", "negate": False, "cpeMatch": cpes}]}]
    return json.dumps({"cve": cve})


def cpe(uri, vulnerable=True):
    d = {"criteria": uri, "matchCriteriaId": "x"}
    if vulnerable is not None:
        d["vulnerable"] = vulnerable
    return d


def bronze_rows(spark, rows):
    """rows: (cve_id, raw_json, ingest_ts, source_file, snapshot_date)."""
    from cvelake.schemas import BRONZE_JSON
    import datetime as dt

    def ts(x):
        return dt.datetime.fromisoformat(x) if x else None

    def d(x):
        return dt.date.fromisoformat(x) if x else None

    return spark.createDataFrame([(a, b, ts(c), e, d(f)) for a, b, c, e, f in rows], BRONZE_JSON)
