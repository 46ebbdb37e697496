"""Streaming latest-wins state: equals the batch dedup, idempotent on replay."""

from pyspark.sql import functions as F

from cvelake.operators.dedup import latest_per_key
from cvelake.streaming import incremental as inc

ORDER = lambda: [F.col("ts").desc(), F.col("event_id").desc()]


def _events(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def _rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "event_id", "ts", "value").collect())


def test_stream_state_equals_batch_and_replay_is_idempotent(spark, tmp):
    ev = _events(spark)
    src, state, ck = f"{tmp}/src", f"{tmp}/state", f"{tmp}/ck"
    halves = (ev.filter(F.col("event_id") % 2 == 0), ev.filter(F.col("event_id") % 2 == 1))
    for part in halves:
        part.write.mode("append").parquet(src)
        inc.run_latest_wins(spark, src, ev.schema, lambda d: d, state, ck, ["user_id"], ORDER, buckets=4)
    want = _rows(latest_per_key(ev, ["user_id"], ORDER()))
    assert _rows(inc.read_state(spark, state, ["user_id"], ORDER)) == want
    # replaying a batch that was already applied changes nothing
    inc.upsert_latest(state, ["user_id"], ORDER, 4)(ev, 99)
    assert _rows(inc.read_state(spark, state, ["user_id"], ORDER)) == want
    # a rerun with nothing new is a no-op (the checkpoint remembers the files)
    inc.run_latest_wins(spark, src, ev.schema, lambda d: d, state, ck, ["user_id"], ORDER, buckets=4)
    assert _rows(inc.read_state(spark, state, ["user_id"], ORDER)) == want


def test_a_batch_with_a_new_column_keeps_the_state(spark, tmp):
    state = f"{tmp}/state"
    put = inc.upsert_latest(state, ["k"], lambda: [F.col("ts").desc()], 4)
    put(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, ts int, v string"), 0)
    put(spark.createDataFrame([(2, 2, "B", "new"), (3, 1, "c", None)], "k int, ts int, v string, extra string"), 1)
    put(spark.createDataFrame([], "k int, ts int, v string"), 2)
    got = sorted((r["k"], r["v"], r["extra"]) for r in inc.read_state(spark, state, ["k"], lambda: [F.col("ts").desc()]).collect())
    assert got == [(1, "a", None), (2, "B", "new"), (3, "c", None)]


def test_a_crash_before_publishing_loses_nothing(spark, tmp, monkeypatch):
    import os

    state = f"{tmp}/state"
    put = inc.upsert_latest(state, ["k"], lambda: [F.col("ts").desc()], 2)
    first = spark.createDataFrame([(i, 1, "a") for i in range(9)], "k int, ts int, v string")
    put(first, 0)
    second = spark.createDataFrame([(i, 2, "b") for i in range(0, 9, 2)], "k int, ts int, v string")
    want = [(i, "b" if i % 2 == 0 else "a") for i in range(9)]
    state_of = lambda: sorted((r["k"], r["v"]) for r in inc.read_state(spark, state, ["k"], lambda: [F.col("ts").desc()]).collect())
    put(second, 1)
    assert state_of() == want
    # Cut off after the data, before the manifest: the version in force still holds.
    os.remove(f"{state}/manifest/version=1/_SUCCESS")
    assert state_of() == [(i, "a") for i in range(9)]
    put(second, 1)  # the replay
    assert state_of() == want
    for epoch in range(2, 6):
        put(second, epoch)
    assert state_of() == want
    assert len([n for n in os.listdir(state) if n.startswith("data-")]) <= 3  # old versions go
    assert len(os.listdir(f"{state}/manifest")) == 2


def _written(state):
    import os

    return {d: sum(os.path.getsize(f"{state}/{d}/{f}") for f in os.listdir(f"{state}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(state) if d.startswith("data-")}


def test_a_batch_writes_what_it_holds_whatever_the_state(spark, tmp):
    sizes = {}
    for n in (2_000, 40_000):
        state = f"{tmp}/state{n}"
        put = inc.upsert_latest(state, ["k"], lambda: [F.col("ts").desc()], 4)
        put(spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("v")), 0)
        before = _written(state)
        put(spark.range(50).select((F.col("id") * 7).alias("k"), F.lit(2).alias("ts"), F.lit("new").alias("v")), 1)
        after = _written(state)
        sizes[n] = sum(after[d] for d in after if d not in before)
        assert set(before) <= set(after)  # the base stays as it is
    assert sizes[40_000] < 1.1 * sizes[2_000]


def test_deltas_become_a_base_before_they_outgrow_it(spark, tmp):
    state, order = f"{tmp}/state", lambda: [F.col("ts").desc(), F.col("v")]
    put = inc.upsert_latest(state, ["k"], order, 3)
    rows, bases = {}, 0
    for epoch in range(12):
        batch = [((epoch * 37 + i) % 400, 20 - epoch if i % 5 == 0 else epoch, f"{epoch}-{i}") for i in range(200)]
        put(spark.createDataFrame(batch, "k int, ts int, v string").repartition(2), epoch)
        for k, ts, v in batch:
            rows[k] = min(rows.get(k, (0, "")) or (0, ""), (-ts, v)) if k in rows else (-ts, v)
        folders = inc._manifest(spark, state, inc._published(spark, state)[-1])[1]
        bases += folders[0].endswith("-base") and len(folders) == 1
        got = {r["k"]: (-r["ts"], r["v"]) for r in inc.read_state(spark, state, ["k"], order).collect()}
        assert got == rows
    assert 1 <= bases < 12


def test_a_continuous_sync_follows_inserts_updates_and_deletes(spark, tmp):
    from cvelake.operators.changes import snapshot_diff

    schema = "k int, v string"
    versions = [[], [(1, "a"), (2, "b"), (3, "c")], [(1, "A"), (3, "c"), (4, "d")], [(2, "again"), (4, "d")]]
    running = None
    try:
        for n in range(1, len(versions)):
            old, new = (spark.createDataFrame(v, schema) for v in versions[n - 1 : n + 1])
            feed = snapshot_diff(old, new, ["k"]).withColumn("_commit_ts", F.timestamp_seconds(F.lit(n)))
            feed.write.mode("append").parquet(f"{tmp}/feed")
            if running is None:
                running = inc.continuous_sync(spark, f"{tmp}/feed", feed.schema, lambda f: f, f"{tmp}/index", f"{tmp}/ck", ["k"], 2, "1 second")
            running.processAllAvailable()
            assert sorted(map(tuple, inc.read_index(spark, f"{tmp}/index", ["k"]).collect())) == versions[n]
    finally:
        if running is not None:
            running.stop()


def test_only_a_missing_state_counts_as_empty(spark, tmp):
    import pytest

    with pytest.raises(ValueError):
        inc.read_state(spark, f"{tmp}/nothing", ["k"], ORDER)


def test_replay_dedup_keeps_one_copy(spark, tmp):
    ev = _events(spark)
    src, out = f"{tmp}/src", f"{tmp}/out"
    for _ in range(2):
        ev.write.mode("append").parquet(src)
    s = inc.dedup_replayed(spark.readStream.schema(ev.schema).parquet(src), ["event_id"], "ts", "1 hour")
    q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    back = spark.read.schema(ev.schema).parquet(out)
    assert back.count() == ev.count() == back.select("event_id").distinct().count()


def test_processing_time_trigger_runs_as_a_continuous_sync(spark, tmp):
    ev = _events(spark)
    src, state, ck = f"{tmp}/src", f"{tmp}/state", f"{tmp}/ck"
    ev.write.mode("append").parquet(src)
    q = inc.run_latest_wins(spark, src, ev.schema, lambda d: d, state, ck, ["user_id"], ORDER, buckets=4,
                            processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert _rows(inc.read_state(spark, state, ["user_id"], ORDER)) == _rows(latest_per_key(ev, ["user_id"], ORDER()))
