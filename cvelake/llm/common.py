"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import cvelake
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with more text than this are handled in several slices of a batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one driver table; read by Spark, so any path that Spark knows works."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(sizes: list[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive (start, end) ranges of rows whose sizes add up to about ``limit``,
    so that one Arrow batch of long texts is never expanded all at once."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def fresh_column(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that no column of ``df`` has (names
    compare without case, as Spark's do)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python, once per application:
    the driver serves it to them, so no folder has to be shared."""
    sc = spark.sparkContext
    if getattr(sc, "_cvelake_shipped", False):
        return
    root = Path(cvelake.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="cvelake-code-"), "cvelake_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    sc._cvelake_shipped = True
