"""Batch job: feed files -> Bronze tables -> Silver -> Gold, one run at a time.

Layout under ``root`` (a shared folder, e.g. under ``spark.checkpoint.dir``
or the warehouse):

    bronze/{nvd_raw,kev_raw,epss_raw}          append-only Parquet
    silver/run=<id>/<table>                    one snapshot per run
    gold/run=<id>/<table>
    silver/dq_metrics                          appended, partitioned by run
    silver/cve_documents_changes               appended change feed, by run

Each run writes into its own folder, so a run never overwrites what it
reads, a failed run leaves the previous snapshot intact, and the change feed
of ``cve_documents`` is the keyed diff between consecutive run folders.
``expect_or_fail`` rules are checked before anything of the run is written.
Silver tables are clustered by ``cve_id`` with a rebalance (AQE splits a
skewed key's partition) so later keyed reads see co-located keys.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.operators import quality as q
from cvelake.operators.changes import snapshot_diff
from cvelake.plans import gold as gd
from cvelake.plans import silver as sv
from cvelake.session import stage
from cvelake.sources import feeds

# Schema names and comments of the catalog layout.
SCHEMAS = {
    "bronze": "Raw feed records, append-only, with provenance",
    "silver": "Validated, deduplicated CVE tables",
    "gold": "Risk-scored analytics tables",
    "agent": "Question logs and cached answers",
}
TABLE_COMMENTS = {
    "cve_core": "Core CVE metadata from NVD; latest record per CVE",
    "cve_signals": "EPSS scores and KEV status per CVE",
    "cve_affected_products": "Vulnerable vendor/product/version per CVE from CPE configurations",
    "cve_documents": "Denormalized searchable text per CVE",
    "vuln_enriched": "CVE records with primary vendor/product, risk score and tier",
    "vendor_risk_agg": "Risk aggregate per vendor",
    "kev_recent": "KEV additions of the last 30 days",
    "nvd_raw": "NVD items as loaded",
    "kev_raw": "KEV entries as loaded",
    "epss_raw": "EPSS rows as loaded",
}


def create_schemas(spark: SparkSession) -> DataFrame:
    """Create the four schemas idempotently and list them."""
    for name, comment in SCHEMAS.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}'")
    return spark.sql("SHOW DATABASES")


def list_schemas(spark: SparkSession) -> DataFrame:
    """The build's schemas that the catalog holds: (schema)."""
    return spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema")).filter(F.col("schema").isin(*SCHEMAS))


def register(spark: SparkSession, schema: str, table: str, path: str) -> None:
    """Expose a folder as ``schema.table`` in the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    spark.sql(f"DROP TABLE IF EXISTS {schema}.{table}")
    spark.catalog.createTable(f"{schema}.{table}", path=path, source="parquet")
    if table in TABLE_COMMENTS:
        spark.sql(f"COMMENT ON TABLE {schema}.{table} IS '{TABLE_COMMENTS[table]}'")
    spark.sql(f"ALTER TABLE {schema}.{table} SET TBLPROPERTIES ('quality' = '{schema}')")


def register_run(spark: SparkSession, root: str, run_id: str) -> list[str]:
    """Expose Bronze and a run's Silver and Gold folders as tables of their
    schemas, with comments and properties; returns the table names."""
    names = []
    for schema, tables in (("silver", ("cve_core", "cve_signals", "cve_affected_products", "cve_documents")),
                           ("gold", ("vuln_enriched", "vendor_risk_agg", "kev_recent"))):
        for t in tables:
            register(spark, schema, t, f"{root}/{schema}/run={run_id}/{t}")
            names.append(f"{schema}.{t}")
    for t in ("nvd_raw", "kev_raw", "epss_raw"):
        register(spark, "bronze", t, f"{root}/bronze/{t}")
        names.append(f"bronze.{t}")
    return names


def ingest(spark: SparkSession, root: str, feed_dir: str, run_ts: str, globs: dict[str, str] | None = None) -> DataFrame:
    """Append every feed file in ``feed_dir`` to Bronze (each run re-reads the
    whole folder, as the original loader does). Returns the run's summary."""
    stamp = F.lit(run_ts).cast("timestamp").alias("ingest_ts")
    for kind, glob in (globs or feeds.GLOBS).items():
        rows, outcomes = feeds.read_files(spark, f"{feed_dir}/{kind}", kind, run_ts, glob)
        # gzip files are unsplittable: spread the items before writing
        # (rebalance: even partitions, skewed ones split by AQE).
        rows = rows.hint("rebalance") if kind == "nvd" else rows
        rows.write.mode("append").parquet(f"{root}/bronze/{kind}_raw")
        # What became of each file, from the same pass.
        outcomes.select(stamp, "*").write.mode("append").parquet(f"{root}/bronze/ingest_files")
    b = bronze(spark, root)
    return feeds.ingest_summary(*[x.filter(F.col("ingest_ts") == F.lit(run_ts).cast("timestamp")) for x in b])


def skipped_files(spark: SparkSession, root: str, run_ts: str | None = None) -> DataFrame:
    """The files that ingests (or the one at ``run_ts``) skipped, as they noted them:
    (kind, source_file, reason)."""
    noted = spark.read.parquet(f"{root}/bronze/ingest_files")
    if run_ts is not None:
        noted = noted.filter(F.col("ingest_ts") == F.lit(run_ts).cast("timestamp"))
    return feeds.skipped_files(noted)


def bronze(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{root}/bronze/{t}") for t in ("nvd_raw", "kev_raw", "epss_raw"))


def silver_path(root: str, run_id: str, table: str) -> str:
    return f"{root}/silver/run={run_id}/{table}"


def build_run(
    spark: SparkSession, root: str, run_id: str, run_ts: str, as_of: str, previous_run_id: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Build Silver and Gold for one run; returns the run's quality metrics.

    With ``buckets``, core, signals and products are also saved as tables
    bucketed by cve_id (same bucket count), and documents and Gold are built
    from those: their joins and per-CVE aggregates then need no shuffle.
    """
    nvd, kev, epss = bronze(spark, root)
    # The pre-rule records feed the tables, and their rows are counted by rule as they
    # are written. Where no rule can stop the run, the core table is written right then:
    # its rows, one for each CVE with its text, come dealt by cve_id from their dedup.
    free = not any(r.action == "fail" for _, rules in (*sv.RECORD_RULES, ("", sv.DOCUMENTS_RULES)) for r in rules)
    records = sv.silver_records(nvd, epss, kev, staged=True, written=True,
                                core_path=silver_path(root, run_id, "cve_core") if free else None)
    metrics = sv.record_metrics(records, run_ts)
    if any(r.action == "fail" for r in sv.DOCUMENTS_RULES):  # has to be known before any table is written
        metrics = sv.metrics_from_records(records, run_ts)
    q.enforce(metrics)  # raise before writing if an expect_or_fail rule is violated
    s = sv.tables_from_records(records)
    for name, df in (("cve_core", s.core), ("cve_signals", s.signals), ("cve_affected_products", s.products)):
        # Clustered by cve_id; AQE splits a skewed partition (a CVE with a
        # huge CPE list) instead of writing it from one task.
        if name == "cve_core" and free:
            continue
        df.hint("rebalance", "cve_id").write.mode("overwrite").parquet(silver_path(root, run_id, name))
    # Documents read the three written tables, as separate tables would.
    core, signals, products = (spark.read.parquet(silver_path(root, run_id, t))
                               for t in ("cve_core", "cve_signals", "cve_affected_products"))
    if buckets:
        b = bucketed_silver(spark, sv.Silver(core, signals, products, None), root, run_id, buckets)
        core, signals, products = b.core, b.signals, b.products
        records, gold = sv.cve_documents_records(core, signals, products), gd.vuln_enriched(core, signals, products)
    else:
        # Documents and Gold join the same rows: texts are dealt once for both.
        facts = sv.product_lists(products).join(gd.primary_products(products), "cve_id")
        joined = stage(core.join(signals, "cve_id", "left").join(facts, "cve_id", "left"), "core-joined")
        records, gold = sv.document_columns(joined), gd.enriched_columns(joined)
    docs, seen = q.counted(records, sv.DOCUMENTS_RULES, "cve_documents")
    q.apply_expectations(docs, sv.DOCUMENTS_RULES).write.mode("overwrite").parquet(silver_path(root, run_id, "cve_documents"))
    if not any(r.action == "fail" for r in sv.DOCUMENTS_RULES):
        metrics = metrics.unionByName(q.counted_metrics(spark, seen, sv.DOCUMENTS_RULES, "cve_documents", run_ts))
    docs = spark.read.parquet(silver_path(root, run_id, "cve_documents"))
    metrics.withColumn("run", F.lit(run_id)).write.mode("append").partitionBy("run").parquet(f"{root}/silver/dq_metrics")
    if previous_run_id is not None:
        old = spark.read.parquet(silver_path(root, previous_run_id, "cve_documents"))
        (snapshot_diff(old, docs, ["cve_id"]).withColumn("_commit_ts", F.lit(run_ts).cast("timestamp"))
         .withColumn("run", F.lit(run_id))
         .write.mode("append").partitionBy("run").parquet(f"{root}/silver/cve_documents_changes"))
    gold.write.mode("overwrite").parquet(f"{root}/gold/run={run_id}/vuln_enriched")
    e = spark.read.parquet(f"{root}/gold/run={run_id}/vuln_enriched")
    gd.vendor_risk_agg(products, e).write.mode("overwrite").parquet(f"{root}/gold/run={run_id}/vendor_risk_agg")
    gd.kev_recent(e, as_of).write.mode("overwrite").parquet(f"{root}/gold/run={run_id}/kev_recent")
    return metrics


def quality_history(spark: SparkSession, root: str) -> DataFrame:
    """The appended expectation metrics of every run, newest run first."""
    return spark.read.parquet(f"{root}/silver/dq_metrics").orderBy(
        F.col("run_ts").desc(), F.col("table"), F.col("rule")
    )


def inspect(df: DataFrame, n: int = 5) -> tuple[int, str, DataFrame]:
    """Row count, schema string and a sample of ``n`` rows."""
    return df.count(), df.schema.simpleString(), df.limit(n)


def partition_by_month(df: DataFrame, ts_col: str = "published") -> DataFrame:
    """Add ``year`` and ``month`` partition columns from a timestamp."""
    return df.withColumn("year", F.year(ts_col)).withColumn("month", F.month(ts_col))


def write_by_month(df: DataFrame, path: str, ts_col: str = "published") -> None:
    """Write a Silver table partitioned by year/month: a date filter on read
    then prunes whole folders."""
    # Clustered first, so that a month is written by few tasks, not by all.
    partition_by_month(df, ts_col).hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Download form of a filtered list: CSV with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "cve_id") -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``key`` at
    ``path`` (in the shared folder) and return the table. Tables bucketed the
    same way join and group on ``key`` without any shuffle.

    The rows are dealt by the key to as many partitions as buckets first: that is the
    hash that buckets go by, so each task writes one file, and there are as many files
    as buckets instead of tasks times buckets."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def bucketed_silver(spark: SparkSession, s: sv.Silver, root: str, run_id: str, buckets: int) -> sv.Silver:
    """Core, signals and products as tables bucketed by cve_id into the same
    number of buckets; documents are derived from them lazily."""
    # If the build has to create the schema, it lives in the build's folder,
    # not in the session's default warehouse.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS silver LOCATION '{root}/warehouse/silver.db'")
    tag = uuid.uuid4().hex[:8]  # one build's table names never collide with another's
    safe_run = re.sub(r"[^A-Za-z0-9_]", "_", run_id)  # e.g. a date: 2024-01-16 -> 2024_01_16
    out = []
    for name, df in (("cve_core", s.core), ("cve_signals", s.signals), ("cve_affected_products", s.products)):
        table = f"silver.{name}_{safe_run}_{tag}"
        out.append(save_bucketed(df, table, f"{root}/silver_bucketed/run={run_id}/{name}", buckets))
    core, signals, products = out
    return sv.Silver(core, signals, products, sv.cve_documents(core, signals, products))
