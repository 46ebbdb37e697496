"""Dashboard datasets (the priority list is a filtered search)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvelake.functions.columns import exact_mean
from cvelake.plans.gold import vendor_risk_agg


def tier_distribution(enriched: DataFrame) -> DataFrame:
    """Number of CVEs per risk tier."""
    return enriched.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("cve_count")).orderBy("risk_tier")


def _long(df: DataFrame) -> DataFrame:
    """A one-row aggregate as (metric, value) rows."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns
    ])))


def data_stats(enriched: DataFrame, products: DataFrame) -> DataFrame:
    """Headline numbers as (metric, value) rows."""
    stats = enriched.agg(
        F.count(F.lit(1)).alias("total_cves"),
        F.count_if(F.col("kev_flag")).alias("kev_count"),
        F.count_if(F.col("risk_tier") == "CRITICAL").alias("critical_count"),
        exact_mean(F.col("risk_score")).alias("avg_risk_score"),
    )
    vendors = products.filter(F.col("vendor").isNotNull()).agg(
        F.count_distinct("vendor").alias("vendor_count")
    )
    return _long(stats).unionByName(_long(vendors))


def top_vendors(products: DataFrame, enriched: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows of the vendor risk aggregate."""
    return vendor_risk_agg(products, enriched).limit(n)
