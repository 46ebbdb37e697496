"""Spark session defaults and the shared scratch location.

The engine relies on three settings: UTC session time (ISO strings without
an offset are parsed as UTC), ANSI mode left on (we use the ``try_`` forms
where a bad value must become NULL), and adaptive query execution with skew
handling for the keyed shuffles.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on wherever it runs.
_ALWAYS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Local runs and tests: few cores, small data, no UI server.
_LOCAL = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
}
# Cluster runs: the launcher sizes spark.sql.shuffle.partitions to the data
# (it is only an upper bound for AQE, which coalesces small partitions and
# splits skewed ones); these keep partitions near 128 MB.
_CLUSTER = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.files.maxPartitionBytes": str(128 << 20),
}


def get_session(master: str | None = None, app: str = "cvelake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` "local[...]" applies the local defaults; on a cluster (no
    master given) the launcher's settings win and only the settings the
    engine relies on are added. Explicit ``conf`` overrides both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    for k, v in {**_ALWAYS, **(_LOCAL if local else _CLUSTER), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the table semantics depend on, on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Texts are written several times (Bronze, Silver, Gold): smaller files.
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) do we pick a fresh local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: no SparkContext on this side
        sc = None
    d = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # not exposed on this session
            d = None
    if not d and sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cvelake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # a static setting on some sessions; the folder is still used
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str, default: str) -> Iterator[None]:
    """A session setting for what is run meanwhile."""
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it
    back: later uses read the written table instead of recomputing the
    lineage, and a lost executor costs a re-read, not a rebuild. What the write
    shuffled is dropped with it, not when the driver collects its garbage."""
    path = scratch_dir(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false"):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for one job's output."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python, once per application;
    the driver serves it to them."""
    sc = spark.sparkContext
    if getattr(sc, "_cvelake_shipped", False):
        return
    root = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="cvelake-code-"), "cvelake_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    sc._cvelake_shipped = True
