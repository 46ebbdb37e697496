"""Gold tables: risk-scored CVEs, vendor risk aggregate, recent KEV additions.

``as_of`` is always an argument (no ``current_date()`` inside the logic) so
a rebuild is reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvelake.functions.columns import TIERS, exact_mean, risk_score, risk_tier
from cvelake.operators.quality import Expectation

SIGNAL_VALUE_COLUMNS = [
    "epss_score", "epss_percentile", "kev_flag", "kev_date_added", "kev_due_date", "kev_ransomware_use", "kev_notes",
]
ENRICHED_COLUMNS = [
    "cve_id", "published", "last_modified", "description", "cvss_v3_score", "cvss_v3_severity", "cvss_v3_vector",
    "cvss_v2_score", "cwe_id", *SIGNAL_VALUE_COLUMNS, "primary_vendor", "primary_product", "risk_score", "risk_tier",
]

_TIER_CASE = "CASE " + " ".join(f"WHEN risk_score >= {t} THEN '{n}'" for t, n in TIERS) + " ELSE 'LOW' END"
GOLD_RULES = (
    Expectation("risk_score_in_range", "risk_score BETWEEN 0 AND 100"),
    Expectation("risk_tier_matches_score", f"risk_tier = {_TIER_CASE}"),
)


def as_of_date(as_of: str | Column | None) -> Column:
    """The reference date as a Column (``current_date()`` when not given)."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def primary_products(products: DataFrame) -> DataFrame:
    """Most common vendor and product per CVE (each on its own; ties go to the
    lowest value; NULLs are ignored). ``mode`` aggregates map-side, so a CVE
    with many CPE rows ships one small map per task."""
    return products.groupBy("cve_id").agg(
        F.mode("vendor", deterministic=True).alias("primary_vendor"),
        F.mode("product", deterministic=True).alias("primary_product"),
    )


def vuln_enriched(core: DataFrame, signals: DataFrame, products: DataFrame) -> DataFrame:
    """Core + signals + primary vendor/product per CVE, with risk score and tier."""
    return enriched_columns(core.join(signals, "cve_id", "left").join(primary_products(products), "cve_id", "left"))


def enriched_columns(j: DataFrame) -> DataFrame:
    """The Gold columns of core joined with signals and primary products."""
    j = j.withColumn("kev_flag", F.coalesce(F.col("kev_flag"), F.lit(False)))
    score = risk_score(F.col("kev_flag"), F.col("epss_score"), F.col("cvss_v3_score"))
    return j.withColumn("risk_score", score).withColumn("risk_tier", risk_tier(F.col("risk_score"))).select(
        *ENRICHED_COLUMNS
    )


def vendor_risk_agg(products: DataFrame, enriched: DataFrame) -> DataFrame:
    """Per vendor over *all* affected products; a CVE counts once per vendor."""
    pairs = products.filter(F.col("vendor").isNotNull()).select("cve_id", "vendor").distinct()
    j = pairs.join(enriched.select("cve_id", "kev_flag", "risk_score", "risk_tier"), "cve_id")
    return (
        j.groupBy("vendor")
        .agg(
            F.count(F.lit(1)).alias("total_cves"),
            F.count_if(F.col("kev_flag")).alias("kev_count"),
            F.count_if(F.col("risk_tier") == "CRITICAL").alias("critical_count"),
            F.count_if(F.col("risk_tier") == "HIGH").alias("high_count"),
            exact_mean(F.col("risk_score")).alias("avg_risk_score"),
            F.max("risk_score").alias("max_risk_score"),
        )
        .orderBy(F.col("kev_count").desc(), F.col("avg_risk_score").desc(), F.col("vendor"))
    )


def recent_kev_filter(days: int, as_of: str | Column | None) -> Column:
    """KEV rows whose date added lies in [as_of - days, as_of]."""
    d = as_of_date(as_of)
    return F.col("kev_flag") & F.col("kev_date_added").between(F.date_sub(d, days), d)


def kev_recent(enriched: DataFrame, as_of: str | Column | None = None, days: int = 30) -> DataFrame:
    """KEV entries added in the last ``days`` days before ``as_of``, newest first."""
    d = as_of_date(as_of)
    return (
        enriched.filter(recent_kev_filter(days, as_of))
        .withColumn("days_since_added", F.datediff(d, F.col("kev_date_added")))
        .orderBy(F.col("kev_date_added").desc(), F.col("cve_id"))
    )
