"""Read schemas for the feed payloads and the table contracts.

Fixed values: the JSON field names below are the public NVD API 2.0 and
CISA KEV field names; they must be spelled exactly like this to read the
feeds. Nothing is inferred: unknown fields are ignored, a wrong-typed leaf
becomes NULL, a malformed document gives an all-NULL struct.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()


def _arr(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


_LANG_VALUE = _arr(_f("lang", S), _f("value", S))
_CVSS3 = _arr(_f("cvssData", T.StructType([_f("baseScore", D), _f("baseSeverity", S), _f("vectorString", S)])))
_CVSS2 = _arr(_f("cvssData", T.StructType([_f("baseScore", D), _f("vectorString", S)])))

CPE_MATCH = T.StructType([
    _f("vulnerable", B), _f("criteria", S), _f("matchCriteriaId", S),
    _f("versionStartIncluding", S), _f("versionStartExcluding", S),
    _f("versionEndIncluding", S), _f("versionEndExcluding", S),
])

# One merged schema for every Silver table that reads an NVD item, so the
# payload is parsed once when several tables are derived in one plan.
NVD_ITEM = T.StructType([
    _f("cve", T.StructType([
        _f("id", S),
        _f("published", S),
        _f("lastModified", S),
        _f("descriptions", _LANG_VALUE),
        _f("metrics", T.StructType([
            _f("cvssMetricV31", _CVSS3),
            _f("cvssMetricV30", _CVSS3),
            _f("cvssMetricV2", _CVSS2),
        ])),
        _f("weaknesses", _arr(_f("description", _LANG_VALUE))),
        _f("configurations", _arr(_f("nodes", _arr(
            _f("operator", S), _f("negate", B), _f("cpeMatch", T.ArrayType(CPE_MATCH)),
        )))),
    ])),
])

KEV_ITEM = T.StructType([
    _f(n, S) for n in (
        "cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded",
        "dueDate", "knownRansomwareCampaignUse", "notes", "shortDescription",
    )
])

# Bronze contracts (column order is part of the contract).
BRONZE_JSON = T.StructType([
    _f("cve_id", S), _f("raw_json", S), _f("ingest_ts", T.TimestampType()),
    _f("source_file", S), _f("snapshot_date", T.DateType()),
])
BRONZE_EPSS = T.StructType([
    _f("cve_id", S), _f("epss_score", D), _f("epss_percentile", D),
    _f("ingest_ts", T.TimestampType()), _f("source_file", S), _f("snapshot_date", T.DateType()),
])

CVE_CORE_COLUMNS = [
    "cve_id", "published", "last_modified", "description", "cvss_v3_score",
    "cvss_v3_severity", "cvss_v3_vector", "cvss_v2_score", "cwe_id",
]
CVE_SIGNALS_COLUMNS = [
    "cve_id", "epss_score", "epss_percentile", "kev_flag", "kev_date_added",
    "kev_due_date", "kev_ransomware_use", "kev_notes",
]
AFFECTED_PRODUCTS_COLUMNS = ["cve_id", "cpe_uri", "vendor", "product", "version"]
CVE_DOCUMENTS_COLUMNS = [
    "cve_id", "document_text", "published", "cvss_v3_score", "cvss_v3_severity",
    "epss_score", "kev_flag", "vendors_str", "products_str", "cwe_id",
]
