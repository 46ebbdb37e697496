"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation is three rounds of random signs and a Hadamard transform; the
hash of a unit vector is the signed axis it then lies nearest to. Every table joins
two such hashes. A hash sees directions only, so vectors are dealt to bands of nearly
equal length: within a band the order by direction is the order by distance.

Vectors are dealt once to blocks of at most ``BLOCK`` or so, and a block keeps its own
tables: hashing is done where the vectors lie, so no copy of a vector goes to each
table. A query visits every block, and in each table of each band it probes the axis
pairs in the order of their distance to it until it has met ``MET`` vectors (and all
of the last pair probed). That rule is the same for tables of any size. What a query
met in any of a block's tables is reranked by Euclidean distance on the original
vectors in double precision, and the block sends its nearest on.

Equal vectors are indexed once, with the few smallest of their ids (more can't be
among the nearest): a vector that a third of all rows share is one entry. Random signs
come from a fixed seed, so tasks agree and results repeat.

Recall on the test tables is measured in tests/llm, below and above ``MET`` vectors a
band; on uniformly random directions in 64 dimensions, the hardest case, the defaults
find over 0.9 of the 10 nearest, whether the vectors are of equal length or not.

Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without an id or vectors of another length than most;
repeated ids are one id; ties go to the smaller id; an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cvelake.llm.common import ship
from cvelake.session import stage

TABLES = 24
#: Vectors that a query meets in a table of a band before it stops probing.
MET = 128
#: Longest to shortest vector of a band; bands beyond ``BANDS`` are merged, smallest first.
BAND_RATIO = 1.1
BANDS = 16
#: Vectors of a block, and queries that visit it in one task.
BLOCK = 16_384
QUERIES = 8_192
#: Rows rotated at once; sized for the processor's cache.
ROWS = 1_024
SEED = 20_240_601

_FOUND = "query long, rep long, score double"


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-rotation of the rows of ``x``, padded to a power of two."""
    if len(x) > ROWS:
        return np.concatenate([rotate(x[at : at + ROWS], seed) for at in range(0, len(x), ROWS)])
    dim = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), dim), np.float32)
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (3, dim))
    for s in signs:
        out *= s
        width = 1
        while width < dim:
            pairs = out.reshape(len(x), -1, 2, width)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), dim)
            width *= 2
    return out / np.float32(dim**1.5)


def nearest_axis(x: np.ndarray) -> np.ndarray:
    """2 * axis, one more if the vector points the other way."""
    at = np.abs(x).argmax(axis=1)
    return 2 * at + (x[np.arange(len(x)), at] < 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class Tables:
    """The tables of one block: for each, the axis pair of every vector."""

    def __init__(self, x: np.ndarray, tables: int, seed: int):
        self.units, self.tables, self.seed = _unit(x), tables, seed
        axes = [[nearest_axis(rotate(self.units, seed + 2 * t + h)) for h in (0, 1)] for t in range(tables)]
        self.axes = np.array(axes, np.int64).reshape(tables, 2, len(x))

    def costs(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each axis, less that to its nearest, by
        table, hash, query and axis."""
        units, out = _unit(queries), []
        for t in range(self.tables):
            for h in (0, 1):
                r = rotate(units, self.seed + 2 * t + h)
                toward = np.stack([r, -r], axis=2).reshape(len(r), -1)  # axis 2a, then 2a + 1
                out.append(np.square(toward.max(axis=1, keepdims=True) - toward))
        return np.array(out).reshape(self.tables, 2, len(queries), -1)

    def met(self, costs: np.ndarray, bands: list[np.ndarray], least: int) -> np.ndarray:
        """Numbers of the vectors that one query meets; ``costs``: (table, hash, axis),
        ``bands``: the vectors of each band."""
        found = np.zeros(self.axes.shape[2], bool)
        for t in range(self.tables):
            cost = costs[t, 0][self.axes[t, 0]] + costs[t, 1][self.axes[t, 1]]
            for own in bands:
                if len(own) <= least:
                    found[own] = True
                else:  # all pairs up to the one that makes the number full
                    part = cost[own]
                    found[own[part <= np.partition(part, least - 1)[least - 1]]] = True
        return np.flatnonzero(found)


def _search_block(k: int, tables: int, least: int, seed: int):
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(queries) and len(block):
            x, reps = _matrix(block.column("embedding")).astype(np.float64), block.column("rep").to_numpy()
            band = block.column("band").to_numpy()
            bands = [np.flatnonzero(band == b) for b in np.unique(band)]
            hashed = Tables(x, tables, seed)
            asked = _matrix(queries.column("embedding")).astype(np.float64)
            names = queries.column("rep").to_pylist()
            for first in range(0, len(asked), 64):
                costs = hashed.costs(asked[first : first + 64])
                for i, (q, rep) in enumerate(zip(asked[first : first + 64], names[first : first + 64], strict=True)):
                    at = hashed.met(costs[:, :, i], bands, least)
                    gap = x[at] - q
                    score = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                    if len(score) > k:  # all that tie with the k-th stay in
                        near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
                        at, score = at[near], score[near]
                        if len(at) > k:
                            near = np.lexsort((reps[at], score))[:k]
                            at, score = at[near], score[near]
                    found.append((np.full(len(at), rep), reps[at], score))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table(dict(zip(("query", "rep", "score"), map(pa.array, columns), strict=True)))

    return run


def _thin(keep: int):
    """Equal vectors of a batch as one row with their ``keep`` smallest ids."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, ids = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            x = x + x.dtype.type(0)  # -0.0 is 0.0
            rows: dict[bytes, int] = {}
            found: dict[bytes, list[int]] = {}
            for i in np.argsort(ids, kind="stable").tolist():
                key = x[i].tobytes()
                rows.setdefault(key, i)
                own = found.setdefault(key, [])
                if len(own) < keep and (not own or own[-1] != ids[i]):
                    own.append(int(ids[i]))
            at = pa.array(list(rows.values()), pa.int64())
            columns = [batch.column("embedding").take(at), pa.array(list(found.values()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["embedding", "ids"])

    return run


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """embedding (floats stay floats, others become doubles), ids (its ``keep``
    smallest vec_ids), rep (the smallest). Batches are thinned before the shuffle, so a
    group holds at most ``keep`` ids of each batch."""
    kind = _kind(vectors)
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    )
    usual = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1)
    dim = (usual.first() or [0])[0]
    few = good.filter(F.size("embedding") == dim).mapInArrow(_thin(keep), f"embedding {kind}, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return few.groupBy("embedding").agg(ids.alias("ids")).withColumn("rep", F.get("ids", F.lit(0)))


def _kind(vectors: DataFrame) -> str:
    kind = vectors.schema["embedding"].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def bands_of(counts: dict[int, int], most: int = BANDS) -> list[tuple[int, int]]:
    """(first step of length, vectors) of each band; ``counts`` is by step. Steps are
    bands until they are too many; then the two neighbours with the fewest vectors merge."""
    bands = sorted(counts.items())
    while len(bands) > most:
        at = min(range(len(bands) - 1), key=lambda i: bands[i][1] + bands[i + 1][1])
        bands[at : at + 2] = [(bands[at][0], bands[at][1] + bands[at + 1][1])]
    return bands


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, tables: int = TABLES, met: int = MET, block: int = BLOCK, seed: int = SEED
) -> DataFrame:
    """For each query (rows vec_id, embedding of ``queries``) its ``k`` nearest among
    the rows of ``vectors`` (vec_id, embedding) other than its own:
    query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    entries = stage(distinct_vectors(vectors, k + 1), "vectors")
    # Queries with the same vector are searched for once.
    own = queries.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast(_kind(vectors)).alias("embedding"))
    asked = stage(own.filter("query_id is not null").join(entries, "embedding").select("query_id", "rep").distinct(), "queries")
    counts = entries.count()
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    shortest = entries.agg(F.min(length)).first()[0] or 1.0
    step = F.floor(F.log(length / shortest) / float(np.log(BAND_RATIO))).cast("int")
    # Lengths are finite numbers, so the steps are a few thousand at most.
    bands = bands_of({r["step"]: r["count"] for r in entries.groupBy(step.alias("step")).count().collect()}) or [(0, 0)]
    band = sum(((step >= low).cast("int") for low, _ in bands[1:]), F.lit(0))
    once = stage(entries.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "embedding"), "query_vectors")

    blocks, parts = max(1, -(-counts // block)), max(1, -(-once.count() // QUERIES))
    dealt = lambda c, n: F.expr(f"cast(pmod(xxhash64({c}), {n}) as int)")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = entries.select("rep", "embedding", band.alias("band"), dealt("rep", blocks).alias("block")).withColumn("part", every(parts))
    visits = once.select("rep", "embedding", dealt("rep", parts).alias("part")).withColumn("block", every(blocks))
    found = visits.groupBy("block", "part").cogroup(index.groupBy("block", "part")).applyInArrow(_search_block(k + 1, tables, met, seed), _FOUND)

    near = Window.partitionBy("query").orderBy("score", "rep")
    best = found.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1)
    listed = best.join(entries.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    # At most (k + 1)^2 per query vector.
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    of_query = asked.join(lists, F.col("rep") == F.col("query"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return of_query.select("query_id", F.posexplode(others).alias("at", "found")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("found.vec_id").alias("vec_id"), F.col("found.score").alias("score")
    )
