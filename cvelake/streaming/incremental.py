"""Incremental (streaming) latest-wins tables, merged on read.

Bronze is an append-only folder of Parquet files. A Structured Streaming
query reads new files only (the file source's checkpoint remembers what was
read, so a file is never processed twice), maps rows to keyed records, and
adds each micro-batch to a keyed state table in ``foreachBatch``:

* a batch is cut to its latest record per key and written as a small delta folder,
  so what a batch writes follows the batch and not the state, and the state is not
  read at all;
* a reader merges: rows of the base whose key no delta holds pass as they are, the
  others compete with the deltas for the latest place. While the deltas are small
  against the base, their keys can be broadcast and the base isn't shuffled;
* once the deltas outgrow a share of the base, the batch also writes a new base of
  everything, dealt by key to a given number of files. A row is so rewritten a bounded
  number of times (1 / share) however long the stream runs;
* the folders in force are listed in a small manifest that is written last, as
  ``manifest/version=<n>``: readers take the newest complete manifest, so a batch is
  visible wholly or not at all, and nothing in force is ever overwritten;
* the manifest names the query and epoch that made it, so an epoch that is
  replayed after it was published changes nothing, and one that was cut off
  before that starts again from the version in force;
* data that neither of the last two versions names is removed;
* a batch with more columns than the state adds them (older rows hold NULL),
  and only a missing state counts as empty: any other error stops the batch.

Latest-wins needs the full ordering, so it cannot use
``dropDuplicatesWithinWatermark`` (which keeps the first row); that operator
is offered separately for replay protection of event streams.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.operators.dedup import latest_per_key
from cvelake.sources import feeds

#: Deltas may have this share of the base's bytes, and so many folders.
COMPACT_SHARE = 0.5
MOST_DELTAS = 32


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system of ``path``, the path): any store Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _published(spark: SparkSession, target: str) -> list[int]:
    """Versions whose manifest is complete, ascending."""
    fs, root = _fs(spark, f"{target}/manifest")
    if not fs.exists(root):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(root)]
    done = [n for n in names if n.startswith("version=") and fs.exists(_fs(spark, f"{target}/manifest/{n}/_SUCCESS")[1])]
    return sorted(int(n.split("=")[1]) for n in done)


def _manifest(spark: SparkSession, target: str, version: int) -> tuple[tuple[str, int], list[str]]:
    """((query, epoch) that made a version, its folders, the base first); at most
    MOST_DELTAS + 2 rows."""
    rows = sorted(spark.read.parquet(f"{target}/manifest/version={version}").collect(), key=lambda r: r["place"])
    return (rows[0]["folder"], rows[0]["epoch"]), [r["folder"] for r in rows[1:]]


def _bytes(spark: SparkSession, folder: str) -> int:
    fs, p = _fs(spark, folder)
    return fs.getContentSummary(p).getLength()


def _merged(spark: SparkSession, target: str, folders: Sequence[str], keys: Sequence[str], order: Callable[[], Sequence[Column]]) -> DataFrame:
    """The latest record per key of a base (the first folder) and its deltas."""
    read = lambda some: spark.read.option("mergeSchema", True).parquet(*[f"{target}/{f}" for f in some])
    base = read(folders[:1])
    if len(folders) == 1:
        return base
    deltas = read(folders[1:])
    touched = deltas.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    again = base.join(touched, same, "left_semi").unionByName(deltas, allowMissingColumns=True)
    return base.join(touched, same, "left_anti").unionByName(latest_per_key(again, keys, order()), allowMissingColumns=True)


def upsert_latest(
    target: str, keys: Sequence[str], order: Callable[[], Sequence[Column]], buckets: int, share: float = COMPACT_SHARE,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function adding each batch to ``target``; a new base is
    written as ``buckets`` files."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        versions = _published(spark, target)
        made, force = _manifest(spark, target, versions[-1]) if versions else (None, [])
        if query and made == (query, epoch):
            return  # published before the stream could note it
        version = versions[-1] + 1 if versions else 0
        latest_per_key(batch, keys, order()).write.mode("overwrite").parquet(f"{target}/data-{version}")
        force = [*force, f"data-{version}"]
        if len(force) > 1:
            deltas = sum(_bytes(spark, f"{target}/{f}") for f in force[1:])
            if len(force) > MOST_DELTAS or deltas > share * _bytes(spark, f"{target}/{force[0]}"):
                whole = _merged(spark, target, force, keys, order).repartition(buckets, *keys)
                force = [f"data-{version}-base"]
                whole.write.mode("overwrite").parquet(f"{target}/{force[0]}")
        rows = [(0, query, epoch), *((n, f, epoch) for n, f in enumerate(force, 1))]
        (spark.createDataFrame(rows, "place int, folder string, epoch long").coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/manifest/version={version}"))
        _remove_old(spark, target, [*versions, version])

    return run


def _remove_old(spark: SparkSession, target: str, versions: list[int]) -> None:
    """Drops manifests but the last two, and data that neither of those names."""
    kept = versions[-2:]
    named = {f for v in kept for f in _manifest(spark, target, v)[1]}
    for v in versions[:-2]:
        fs, p = _fs(spark, f"{target}/manifest/version={v}")
        fs.delete(p, True)
    fs, root = _fs(spark, target)
    for x in fs.listStatus(root):
        name = x.getPath().getName()
        if name.startswith("data-") and name not in named:
            fs.delete(x.getPath(), True)


def run_latest_wins(
    spark: SparkSession,
    source_dir: str,
    source_schema,
    to_records: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Callable[[], Sequence[Column]],
    buckets: int,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
):
    """Process every Bronze file not yet seen, then stop (availableNow).

    With ``processing_time`` (e.g. ``"10 minutes"``) the same query keeps
    running as a continuous sync and the running query handle is returned.
    """
    reader = spark.readStream.schema(source_schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = to_records(reader.load(source_dir))
    w = (
        records.writeStream.foreachBatch(upsert_latest(target, keys, order, buckets))
        .option("checkpointLocation", f"{checkpoint}/offsets")
    )
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return None


def read_state(spark: SparkSession, target: str, keys: Sequence[str], order: Callable[[], Sequence[Column]]) -> DataFrame:
    """The state table in force: ``keys`` and ``order`` as its stream has them."""
    versions = _published(spark, target)
    if not versions:
        raise ValueError(f"no state in {target}")
    return _merged(spark, target, _manifest(spark, target, versions[-1])[1], keys, order)


def continuous_sync(
    spark: SparkSession, feed_dir: str, feed_schema, to_index: Callable[[DataFrame], DataFrame], target: str, checkpoint: str,
    keys: Sequence[str], buckets: int, processing_time: str = "10 minutes",
):
    """A running query that keeps a keyed index in step with a change feed: a folder
    of feeds as :func:`~cvelake.operators.changes.snapshot_diff` makes them, each with
    the ``_commit_ts`` of its version. Images before an update are left out, and a
    deleted key stays as a mark until a newer version brings it back. Read the index
    with :func:`read_index`."""
    feed = spark.readStream.schema(feed_schema).parquet(feed_dir).filter("_change_type <> 'update_preimage'")
    records = to_index(feed)
    writer = records.writeStream.foreachBatch(upsert_latest(target, keys, newest_change, buckets))
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=processing_time).start()


def newest_change() -> list[Column]:
    # Within one version a key is either deleted or has one image.
    return [F.col("_commit_ts").desc(), F.col("_change_type")]


def read_index(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    found = read_state(spark, target, keys, newest_change)
    return found.filter("_change_type <> 'delete'").drop("_change_type", "_commit_ts")


def dedup_replayed(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop rows replayed within ``delay`` of the first copy (keeps the first)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_ingest(spark: SparkSession, kind: str, feed_dir: str, bronze_dir: str, checkpoint: str, run_ts: str,
                  glob: str | None = None) -> None:
    """Append feed files of one ``kind`` (nvd, kev, epss) not ingested before to
    Bronze: the file source's checkpoint remembers every file it has read, so a
    rerun over the same folder adds only new files. Each micro-batch is a folder of
    its epoch, so it is there exactly once."""

    def run(batch: DataFrame, epoch: int) -> None:
        # Only whole files that are well formed give rows. A replayed epoch writes
        # the same folder again.
        rows = feeds.bronze_of(batch, kind, run_ts)
        rows.write.mode("overwrite").parquet(f"{bronze_dir}/epoch={epoch}")

    stream = feeds.feed_pieces(spark.readStream, feed_dir, kind, glob)
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
