"""Quality reporting over runs: metrics history, severity, trend, escalation,
and would-drop counts per snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvelake.operators import quality as q
from cvelake.plans import silver as sv


def as_of_run(bronze: DataFrame, run_ts: str) -> DataFrame:
    """Bronze as it stood after the run at ``run_ts`` (Bronze is append-only,
    so time travel is a filter on ``ingest_ts`` that reaches the scan)."""
    return bronze.filter(F.col("ingest_ts") <= F.lit(run_ts).cast("timestamp"))


def metrics_history(
    bronze_nvd: DataFrame, bronze_epss: DataFrame, bronze_kev: DataFrame, runs: Sequence[str], staged: bool = False,
) -> DataFrame:
    out = None
    for r in runs:
        m = sv.silver_metrics(as_of_run(bronze_nvd, r), as_of_run(bronze_epss, r), as_of_run(bronze_kev, r), r,
                              staged=staged)
        out = m if out is None else out.unionByName(m)
    return out


def failures_from_records(records: sv.Records, bronze_epss: DataFrame) -> DataFrame:
    """(table, rule, source_file, failed) from pre-rule records that carry
    ``source_file`` (the Bronze file each surviving record came from)."""
    parts = []

    def per_file(df: DataFrame, rules, table: str) -> None:
        for r in rules:
            parts.append(
                df.groupBy("source_file").agg(F.count_if(~r.holds()).alias("failed")).select(
                    F.lit(table).alias("table"), F.lit(r.name).alias("rule"), "source_file", "failed",
                )
            )

    per_file(records.core, sv.CORE_RULES, "cve_core")
    per_file(sv.latest_epss(bronze_epss, keep=["source_file"]), sv.SIGNALS_RULES, "cve_signals")
    per_file(records.products, sv.PRODUCTS_RULES, "cve_affected_products")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failures_by_file(bronze_nvd: DataFrame, bronze_epss: DataFrame, run_ts: str) -> DataFrame:
    """(table, rule, source_file, failed) for the Silver records of one run."""
    nvd, epss = as_of_run(bronze_nvd, run_ts), as_of_run(bronze_epss, run_ts)
    parsed = sv.parse_nvd(nvd)
    rec = sv.Records(sv.cve_core_records(parsed, keep=["source_file"]), None,
                     sv.affected_products_records(parsed, keep=["source_file"]))
    return failures_from_records(rec, epss)


def escalation_report(
    bronze_nvd: DataFrame, bronze_epss: DataFrame, bronze_kev: DataFrame, runs: Sequence[str]
) -> DataFrame:
    """Escalation of the newest run; each run's Bronze is parsed once and its
    staged records feed both the metrics and the per-file attribution."""
    history, last = None, None
    for r in runs:
        rec = sv.silver_records(as_of_run(bronze_nvd, r), as_of_run(bronze_epss, r), as_of_run(bronze_kev, r),
                                staged=True, keep=("source_file",))
        m = sv.metrics_from_records(rec, r)
        history = m if history is None else history.unionByName(m)
        last = rec
    return q.escalation(history, failures_from_records(last, as_of_run(bronze_epss, runs[-1])))


def snapshot_drop_counts(bronze_nvd: DataFrame) -> DataFrame:
    """Records and would-be-dropped records (no English description) per
    snapshot date, over every Bronze row (the payload is parsed first)."""
    desc = sv.first_value(F.from_json("raw_json", sv.NVD_ITEM)["cve"]["descriptions"])
    return (
        bronze_nvd.select("snapshot_date", desc.alias("description"))
        .groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("description").isNull()).alias("would_drop"),
        )
        .orderBy(F.col("snapshot_date").desc())
    )


def malformed_ids(bronze_nvd: DataFrame, with_payload: bool = False) -> DataFrame:
    """Bronze rows whose id breaks the CVE format, to trace a warn failure
    back to its source file."""
    from cvelake.functions.columns import CVE_ID_PATTERN

    cols = ["cve_id", "source_file", "snapshot_date", "ingest_ts"] + (["raw_json"] if with_payload else [])
    return bronze_nvd.filter(~F.coalesce(F.col("cve_id").rlike(CVE_ID_PATTERN), F.lit(False))).select(*cols)


def short_description_count(core: DataFrame, signals: DataFrame, limit: int = 50) -> DataFrame:
    """Simulated document-length test: core rows (left-joined to signals)
    whose description alone is at most ``limit`` characters."""
    j = core.join(signals, "cve_id", "left")
    return j.agg(F.count_if(F.length("description") <= limit).alias("would_fail"))


def records_per_file(bronze: DataFrame, source: str) -> DataFrame:
    """Accumulated Bronze records per source file and snapshot."""
    return bronze.groupBy("source_file", "snapshot_date").agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(source).alias("source"), "source_file", "snapshot_date", "records"
    )
