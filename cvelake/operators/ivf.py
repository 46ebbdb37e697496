"""Cell index for cosine top-k: vectors filed under k-means cells, searched cell by cell.

* Cells are trained by spherical k-means in numpy on a bounded sample (at most
  ``PER_CELL`` vectors for each cell and ``SAMPLE_FLOATS`` numbers in all, those with the
  smallest hashes of their ids); every vector of the table is then filed under its
  nearest cell, with no limit.
* A query visits its ``probes`` nearest cells and scores their vectors exactly. Its work
  follows the cells it visits, not the table. Cells and the queries that visit them are
  cut into blocks of bounded size, so a cell that holds a third of all vectors (one
  vector repeated) is many tasks. A block's vectors become matrices once, and a cell's
  scores are a matrix product of which only those that reach the query's k-th best so far
  are looked at further.
* With ``exact`` a second round visits every other cell that may still hold a better
  vector: no vector of a cell is nearer to the query than its centre's angle less the
  cell's radius. Where vectors lie in groups that leaves few cells; for directions
  without any structure the bound rules out little and the search costs as much as a
  full one, but the result is always the full search's.

Null, zero and non-finite vectors are not filed and find nothing. All vectors have the
same number of components.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cvelake.operators.vector import BestScores
from cvelake.session import ship, stage

PER_CELL = 64
#: Vectors of a block and queries that are sent to it together, at most, and numbers that
#: either has at most. A query is sent once for each block that it visits and a vector once
#: for each block of queries, so what is shuffled falls with the size of the blocks; tables
#: of fewer than DEALT blocks have smaller ones, so that every core has some.
CANDIDATE_BLOCK = ASKED_BLOCK = 65_536
BLOCK_FLOATS, LEAST_BLOCK, DEALT = 4 << 20, 8192, 12
#: Queries whose scores are taken at a time, with so many vectors of a cell: 8 MB. Rows
#: that are sent at a time.
QUERY_BLOCK, SCORED_VECTORS, SENT_ROWS = 1024, 1024, 1024
SAMPLE_FLOATS = 16_000_000
MOST_CELLS = 4096
PROBES = 8
ROUNDS = 12
SEED = 4
#: Room for the rounding of angles.
MARGIN = 1e-6


@dataclasses.dataclass
class CellIndex:
    """``filed`` (written): cell, id, vector. ``angles``: each cell's radius."""

    filed: DataFrame
    id_col: str
    vec_col: str
    centres: np.ndarray
    angles: np.ndarray
    sizes: dict[int, int]


def _matrix(column: pa.Array) -> np.ndarray:
    """A row for each vector; zeros where it is null or shorter than others."""
    sizes, flat = np.diff(column.offsets.to_numpy()), column.flatten()
    if len(column) and not column.null_count and not flat.null_count and (sizes == sizes[0]).all():
        return flat.to_numpy().astype(np.float64).reshape(len(column), sizes[0])
    rows = column.to_pylist()
    dims = max((len(r) for r in rows if r is not None), default=0)
    return np.array([r if r is not None and len(r) == dims else [0.0] * dims for r in rows], np.float64).reshape(len(rows), dims)


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, whether a row has one)."""
    x = _matrix(column)
    norm = np.linalg.norm(x, axis=1)
    good = np.isfinite(norm) & (norm > 0)
    return x / np.where(good, norm, 1)[:, None], good


def train(units: np.ndarray, cells: int, seed: int = SEED) -> np.ndarray:
    """Unit centres by spherical k-means; a cell that loses all its rows keeps its centre."""
    rng = np.random.default_rng(seed)
    centres = units[rng.choice(len(units), min(cells, len(units)), replace=False)]
    for _ in range(ROUNDS):
        own = (units @ centres.T).argmax(axis=1)
        order = np.argsort(own, kind="stable")
        met, first = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(units[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres[met] = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres[met])
    return centres


def build(vectors: DataFrame, vec_col: str, id_col: str, cells: int | None = None, seed: int = SEED) -> CellIndex:
    """Files ``vectors`` under ``cells`` cells (by default as many as the root of their
    number, MOST_CELLS at most)."""
    ship(vectors.sparkSession)
    whole = vectors.select(F.col(id_col), F.col(vec_col)).filter(F.col(vec_col).isNotNull())
    norm2 = F.aggregate(F.col(vec_col).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    whole = stage(whole.filter((norm2 > 0) & (norm2 < float("inf"))), "cell-vectors")
    n, dims = whole.agg(F.count("*"), F.max(F.size(vec_col))).first()
    cells = cells or min(MOST_CELLS, max(1, int(np.sqrt(n))))
    most = min(PER_CELL * cells, SAMPLE_FLOATS // max(1, dims or 1))
    sample = whole.orderBy(F.xxhash64(id_col, F.lit(seed)), id_col).limit(most).select(vec_col).toArrow().column(0).combine_chunks()
    units, good = _units(sample)
    if not good.any():
        return CellIndex(whole.withColumn("cell", F.lit(0)), id_col, vec_col, np.zeros((0, 0)), np.zeros(0), {})
    centres = train(units[good], cells, seed)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _units(batch.column(vec_col))[0] @ centres.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.argmax(axis=1), pa.int32()), pa.array(near.max(axis=1, initial=-1.0)), *batch.columns],
                names=["cell", "near", *batch.schema.names])

    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("near", T.DoubleType()), *whole.schema.fields])
    filed = stage(whole.mapInArrow(file, schema), "cells")
    angles, sizes = np.zeros(len(centres)), {}
    for r in filed.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("near")).collect():  # a row for each cell
        angles[r["cell"]], sizes[r["cell"]] = np.arccos(np.clip(r["near"], -1, 1)), r["n"]
    return CellIndex(filed.drop("near"), id_col, vec_col, centres, angles, sizes)


def _block(most: int, rows: int, dims: int) -> int:
    """Rows of a block of a table of so many rows."""
    return max(1, min(most, BLOCK_FLOATS // max(1, dims), max(LEAST_BLOCK, -(-rows // DEALT))))


def _groups(index: CellIndex) -> dict[int, tuple[int, int]]:
    """Cell -> (group, blocks of the group): neighbouring numbers share a group until it
    has a block of vectors, so that a query is sent once for many small cells."""
    out, group, own, total = {}, 0, [], 0
    block = _block(CANDIDATE_BLOCK, sum(index.sizes.values()), index.centres.shape[1])
    for cell in [*sorted(index.sizes), None]:
        if own and (cell is None or total + index.sizes[cell] > block):
            out |= {c: (group, -(-total // block)) for c in own}
            group, own, total = group + 1, [], 0
        if cell is not None:
            own.append(cell)
            total += index.sizes[cell]
    return out


def _sent(index: CellIndex, queries: DataFrame, probes: int, least: str | None) -> DataFrame:
    """(query_id, _query, group, cells, _known): the ``probes`` nearest cells of each query, by
    group; with ``least``, the other cells that may hold a score above that column's, which
    is ``_known`` then."""
    centres, angles = index.centres, index.angles
    groups = np.full(len(centres), -1)
    for cell, (group, _) in _groups(index).items():
        groups[cell] = group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, good = _units(batch.column("_query"))
            if not good.any():
                continue
            near = units @ centres.T
            first = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            asked = np.zeros(near.shape, bool)
            np.put_along_axis(asked, first, True, axis=1)
            known = batch.column(least) if least else pa.nulls(len(batch), pa.float64())
            if least:
                bound = np.cos(np.maximum(0, np.arccos(np.clip(near, -1, 1)) - angles))
                known_or_less = known.fill_null(-2.0).to_numpy()
                asked = ~asked & (bound >= known_or_less[:, None] - MARGIN)
            row, cell = np.nonzero(asked & good[:, None] & (groups >= 0))  # by query and cell, so by group
            pair = row * (groups.max() + 1) + groups[cell]
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
            ends = np.concatenate([first, [len(pair)]])
            for at in range(0, len(first), SENT_ROWS):
                own = first[at : at + SENT_ROWS]
                some, places = pa.array(row[own]), ends[at : at + len(own) + 1]
                cells = pa.ListArray.from_arrays(pa.array(places - places[0], pa.int32()), pa.array(cell[places[0] : places[-1]], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(some), batch.column("_query").take(some), pa.array(groups[cell[own]], pa.int32()), cells, known.take(some)],
                    names=["query_id", "_query", "group", "cells", "_known"])

    columns = ["query_id", "_query", *([least] if least else [])]
    schema = T.StructType([queries.schema["query_id"], queries.schema["_query"], T.StructField("group", T.IntegerType()),
                           T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("_known", T.DoubleType())])
    return queries.select(*columns).mapInArrow(run, schema)


def _visits(index: CellIndex, queries: DataFrame, probes: int, least: str | None) -> DataFrame:
    """:func:`_sent` as a row for each cell: (query_id, _query, cell)."""
    return _sent(index, queries, probes, least).select("query_id", "_query", F.explode("cells").alias("cell"))


def _scores(index: CellIndex, visits: DataFrame, k: int) -> DataFrame:
    """The k best of each block of a cell for each query that visits it."""
    spark = visits.sparkSession
    visits = stage(visits, "cell-visits")
    groups = _groups(index)
    block = _block(ASKED_BLOCK, sum(index.sizes.values()), index.centres.shape[1])
    # At most MOST_CELLS rows.
    asked = {r["group"]: r["count"] for r in visits.groupBy("group").count().collect()}
    blocks = F.broadcast(spark.createDataFrame(
        sorted({(g, n, -(-asked[g] // block)) for g, n in groups.values() if g in asked}), "group int, _nc long, _nq long"))
    of_cell = F.broadcast(spark.createDataFrame([(c, g) for c, (g, _) in groups.items()], "cell int, group int"))

    def dealt(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        placed = df.join(blocks, "group").withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_n) - 1))).drop("_nc", "_nq")

    kinds = [index.filed.schema[index.id_col].dataType, visits.schema["query_id"].dataType]
    id_type, qid_type = map(to_arrow_type, kinds)
    schema = pa.schema([("query_id", qid_type), (index.id_col, id_type), ("_score", pa.float64())])
    id_col, vec_col = index.id_col, index.vec_col

    def score(asked: pa.Table, vectors: pa.Table) -> pa.Table:
        """Cell by cell, the vectors of a cell and the queries that visit it."""
        if not len(asked) or not len(vectors):
            return schema.empty_table()
        vectors = vectors.select(["cell", id_col, vec_col]).take(pc.sort_indices(vectors, sort_keys=[(id_col, "ascending")], null_placement="at_start"))  # a tie goes to the smaller id
        (q, _), (x, _) = (_units(c.combine_chunks()) for c in (asked.column("_query"), vectors.column(vec_col)))
        known = asked.column("_known").combine_chunks().fill_null(-np.inf).to_numpy()
        best = BestScores(len(q), k, known)
        cells = asked.column("cells").combine_chunks()
        row = np.repeat(np.arange(len(q), dtype=np.int32), np.diff(cells.offsets.to_numpy()))
        wanted, filed = cells.flatten().to_numpy(), vectors.column("cell").to_numpy()
        (by_visit, visits), (by_cell, members) = ((np.argsort(c, kind="stable"), np.sort(c)) for c in (wanted, filed))
        found = []
        for cell in np.unique(filed):
            some = row[by_visit[slice(*np.searchsorted(visits, [cell, cell + 1]))]]
            own = by_cell[slice(*np.searchsorted(members, [cell, cell + 1]))]
            for low in range(0, len(own), SCORED_VECTORS):
                part = own[low : low + SCORED_VECTORS]
                turned = np.ascontiguousarray(x[part].T)
                for at in range(0, len(some), QUERY_BLOCK):
                    rows = some[at : at + QUERY_BLOCK]
                    scores = q[rows] @ turned
                    r, c = best.take(scores, rows)
                    found.append((rows[r], part[c], scores[r, c]))
        r, c, scores = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2 + (np.zeros(0),)
        good = best.still(r, scores)
        return pa.table([asked.column("query_id").take(pa.array(r[good])), vectors.column(id_col).take(pa.array(c[good])), pa.array(scores[good])], schema=schema)

    by = ["group", "_cb", "_qb"]
    return (
        dealt(visits, "query_id", "_qb", "_nq", "_cb", "_nc").groupBy(*by)
        .cogroup(dealt(index.filed.join(of_cell, "cell"), index.id_col, "_cb", "_nc", "_qb", "_nq").groupBy(*by))
        .applyInArrow(score, f"query_id {kinds[1].simpleString()}, {index.id_col} {kinds[0].simpleString()}, _score double")
    )


def search(index: CellIndex, queries: DataFrame, query_id: str, query_vec: str, k: int, probes: int = PROBES, exact: bool = False) -> DataFrame:
    """Per query: the best ``k`` of the cells it visits (query_id, rank, id, score); with
    ``exact`` the best of all vectors."""
    q = queries.filter(F.col(query_vec).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_query"))
    w = Window.partitionBy("query_id").orderBy(F.round("_score", 9).desc(), F.col(index.id_col))

    def best(scored: DataFrame) -> DataFrame:
        return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    if not len(index.centres):
        kinds = q.schema["query_id"].dataType.simpleString(), index.filed.schema[index.id_col].dataType.simpleString()
        return q.sparkSession.createDataFrame([], f"query_id {kinds[0]}, rank int, `{index.id_col}` {kinds[1]}, score double")
    found = best(_scores(index, _sent(index, q, probes, None), k))
    if exact:
        found = stage(found, "cell-first")
        least = found.filter(F.col("rank") == k).select(F.col("query_id").alias("_of"), F.round("_score", 9).alias("_least"))
        asked = q.join(least, F.col("query_id") == F.col("_of"), "left").drop("_of")
        found = best(found.drop("rank").unionByName(_scores(index, _sent(index, asked, probes, "_least"), k)))
    return found.select("query_id", "rank", index.id_col, F.round("_score", 6).alias("score"))
