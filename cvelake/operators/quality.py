"""Declarative data-quality expectations.

An :class:`Expectation` is a named SQL predicate plus an action:

* ``warn``  keep every row, count the violations;
* ``drop``  remove violating rows, count them;
* ``fail``  compute the metrics first and raise before anything is written.

A NULL predicate result counts as a violation. Every rule is counted over
the same full input (before any drop) in one aggregate pass: the aggregate
is partial per partition, so the metrics cost one small row per task in the
shuffle regardless of table size. Where the rows are written anyway, the same
counts are observed on the write and cost no scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")

# Warn-rate bands (below LOW_RATE low, up to MEDIUM_RATE medium,
# above high) and the escalation limits (fewer than FEW_FAILURES failures is
# isolated; a drop rate above CRITICAL_DROP_RATE is critical).
LOW_RATE, MEDIUM_RATE = 0.001, 0.01
FEW_FAILURES, CRITICAL_DROP_RATE = 10, 0.05

@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationFailed(RuntimeError):
    pass


def _counts(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), *[F.count_if(r.holds()).alias(f"p{i}") for i, r in enumerate(rules)]]


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation], table: str, run_ts: str | Column) -> DataFrame:
    """One row per rule: total, passed, failed, dropped, pass_rate."""
    return _metric_rows(df.agg(*_counts(rules)), rules, table, run_ts)


def counted(df: DataFrame, rules: Sequence[Expectation], table: str) -> tuple[DataFrame, Observation]:
    """``df``, whose rows are counted by rule while it is written: the counts of
    :func:`expectation_metrics` without a scan of their own. Write it as it is, or
    after steps that need no shuffle, so that a retried task isn't counted twice."""
    seen = Observation(f"{table}-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *_counts(rules)), seen


def counted_metrics(spark: SparkSession, seen: Observation, rules: Sequence[Expectation], table: str, run_ts: str | Column) -> DataFrame:
    """:func:`expectation_metrics` of a frame that was written as :func:`counted`."""
    names = ["total", *[f"p{i}" for i in range(len(rules))]]
    found = seen.get  # empty where there was nothing to write
    row = spark.createDataFrame([tuple(found.get(n, 0) for n in names)], ", ".join(f"{n} long" for n in names))
    return _metric_rows(row, rules, table, run_ts)


def _metric_rows(agg: DataFrame, rules: Sequence[Expectation], table: str, run_ts: str | Column) -> DataFrame:
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col(f"p{i}").alias("passed"),
        )
        for i, r in enumerate(rules)
    ])
    out = agg.select("total", F.inline(rows))
    failed = F.col("total") - F.col("passed")
    return out.select(
        ts.alias("run_ts"),
        F.lit(table).alias("table"),
        "rule",
        "action",
        "total",
        "passed",
        failed.alias("failed"),
        F.when(F.col("action") == "drop", failed).otherwise(F.lit(0)).cast("long").alias("dropped"),
        F.try_divide(F.col("passed"), F.col("total")).cast("double").alias("pass_rate"),
    )


def apply_expectations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows that pass every ``drop`` rule (``warn`` and ``fail`` keep rows)."""
    cond = None
    for r in rules:
        if r.action == "drop":
            cond = r.holds() if cond is None else cond & r.holds()
    return df if cond is None else df.filter(cond)


def enforce(metrics: DataFrame) -> None:
    """Raise if a ``fail`` rule has violations (metrics hold one row per rule)."""
    bad = metrics.filter((F.col("action") == "fail") & (F.col("failed") > 0)).select("table", "rule", "failed").collect()
    if bad:
        detail = ", ".join(f"{r['table']}.{r['rule']}: {r['failed']}" for r in bad)
        raise ExpectationFailed(f"expect_or_fail violated: {detail}")


def warn_severity(metrics: DataFrame) -> DataFrame:
    """Failure-rate band per rule: < 0.1 % LOW, 0.1 - 1 % MEDIUM, > 1 % HIGH."""
    rate = F.try_divide(F.col("failed"), F.col("total")).cast("double")
    return metrics.select(
        "run_ts", "table", "rule", "action", "failed",
        rate.alias("failure_rate"),
        F.when(rate < LOW_RATE, "LOW").when(rate <= MEDIUM_RATE, "MEDIUM").when(rate > MEDIUM_RATE, "HIGH")
        .alias("severity"),
    )


def failure_trend(history: DataFrame) -> DataFrame:
    """Failure rate per rule compared with the previous run of the same rule."""
    w = Window.partitionBy("table", "rule").orderBy("run_ts")
    # Unrounded: one IEEE division of two counts, the same in every engine.
    rate = F.try_divide(F.col("failed"), F.col("total")).cast("double")
    return (
        history.withColumn("failure_rate", rate)
        .withColumn("prev_failure_rate", F.lag("failure_rate").over(w))
        .select(
            "run_ts", "table", "rule", "failed", "failure_rate", "prev_failure_rate",
            F.coalesce(F.col("failure_rate") > F.col("prev_failure_rate"), F.lit(False)).alias("rising"),
        )
    )


def escalation(history: DataFrame, failures_by_file: DataFrame) -> DataFrame:
    """Escalation level of the newest run of each rule.

    CRITICAL: a drop rule removes more than 5 % of its input;
    HIGH: the failure rate rose against the previous run;
    MEDIUM: 10 or more failures, all from one source file;
    LOW: fewer than 10 failures; otherwise MEDIUM (a spread-out pattern).
    ``failures_by_file`` holds (table, rule, source_file, failed) for the
    newest run, counted on the Bronze rows that feed the rule.
    """
    trend = failure_trend(history)
    w = Window.partitionBy("table", "rule").orderBy(F.col("run_ts").desc())
    newest = (
        trend.join(history.select("run_ts", "table", "rule", "action", "total", "dropped"), ["run_ts", "table", "rule"])
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .drop("_rn")
    )
    files = failures_by_file.filter(F.col("failed") > 0).groupBy("table", "rule").agg(
        F.count(F.lit(1)).alias("files_with_failures")
    )
    j = newest.join(files, ["table", "rule"], "left")
    drop_rate = F.try_divide(F.col("dropped"), F.col("total"))
    level = (
        F.when((F.col("action") == "drop") & (drop_rate > CRITICAL_DROP_RATE), "CRITICAL")
        .when(F.col("rising"), "HIGH")
        .when((F.col("failed") >= FEW_FAILURES) & (F.coalesce(F.col("files_with_failures"), F.lit(0)) == 1), "MEDIUM")
        .when(F.col("failed") < FEW_FAILURES, "LOW")
        .otherwise("MEDIUM")
    )
    return j.select(
        "table", "rule", "action", "failed", "failure_rate", "rising",
        F.coalesce(F.col("files_with_failures"), F.lit(0)).cast("long").alias("files_with_failures"),
        level.alias("escalation"),
    )
