"""Exact cosine top-k over an ``ARRAY<FLOAT>`` column.

* :func:`cosine_topk` scores one query vector with JVM built-ins
  (``zip_with`` + ``aggregate`` in double precision) and cuts with
  ``orderBy().limit()``, which Spark runs as a per-partition top-k plus one
  small merge (TakeOrderedAndProject): nothing but k rows per task moves.
* :func:`batch_cosine_topk` scores many query vectors at once. Queries and
  candidates are dealt to blocks of bounded size, and every pair of blocks is one
  task: a matrix product of which only the best k per query leave the task. No
  vector reaches the driver. A window per query then takes the final top k,
  pre-limited map-side by Spark. (The work is queries times candidates, since the
  result is exact; :mod:`.ivf` has an index for large corpora.)

Scores are ranked on their value rounded to 9 decimals, then on the id, so
near-equal scores from different summation orders rank the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

QUERY_BLOCK = 1024  # queries of one block
CANDIDATE_BLOCK = 8192  # candidates of one block: a score block has 64 MB


def _dot(a: Column, b: Column) -> Column:
    prod = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def _norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(_dot(a, b), _norm(a) * _norm(b))


def cosine_topk(candidates: DataFrame, vec_col: str, query: Sequence[float], k: int, id_col: str) -> DataFrame:
    """Top ``k`` rows of ``candidates`` by cosine similarity to ``query``.

    Adds ``score`` (rounded to 6 decimals) and ``rank`` (1..k).
    """
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = candidates.withColumn("_score", cosine(F.col(vec_col), q))
    top = scored.orderBy(F.round("_score", 9).desc_nulls_last(), F.col(id_col)).limit(k)
    w = Window.orderBy(F.round("_score", 9).desc_nulls_last(), F.col(id_col))
    # The window runs over the k rows left after the limit only.
    return top.withColumn("rank", F.row_number().over(w)).withColumn("score", F.round("_score", 6)).drop("_score")


def score_blocks(k: int, id_col: str, vec_col: str, id_type: pa.DataType, qid_type: pa.DataType):
    def matrix(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
        rows = table.column(column).to_pylist()
        x = np.array(rows, dtype=np.float64).reshape(len(rows), -1)
        norm = np.linalg.norm(x, axis=1)
        norm[norm == 0] = np.nan
        return x, norm

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", qid_type), (id_col, id_type), ("_score", pa.float64())])
        if not len(queries) or not len(candidates):
            return schema.empty_table()
        (q, qn), (x, xn) = matrix(queries, "_query"), matrix(candidates, vec_col)
        score = (x @ q.T) / np.outer(xn, qn)
        r = np.where(np.isnan(score), -np.inf, np.round(score, 9))
        # k-th best rounded score per query; keep every row at or above it.
        kk = min(k, len(x))
        kth = np.partition(r, len(x) - kk, axis=0)[len(x) - kk]
        rows, cols = np.nonzero((r >= kth[None, :]) & np.isfinite(r))
        return pa.table([queries.column("query_id").take(pa.array(cols)), candidates.column(id_col).take(pa.array(rows)),
                         pa.array(score[rows, cols])], schema=schema)

    return run


class BestScores:
    """The ``k`` best scores of each query so far, by value: scores below them are no
    hits any more. ``least``, if given, is a score that a query has ``k`` hits of."""

    def __init__(self, queries: int, k: int, least: np.ndarray | None = None):
        self.k = k
        self.top = np.full((queries, k), -np.inf)
        if least is not None:
            self.top[:] = least[:, None]

    def take(self, scores: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of the scores that may be hits: at most ``k`` of a row, by their
        value rounded to 9 decimals, then by column. ``queries`` are the rows' queries."""
        k, low = self.k, self.top[queries].min(axis=1)
        found = scores >= (low - 1e-9)[:, None]
        many = np.flatnonzero(np.count_nonzero(found, axis=1) > 4 * k)
        for at in range(0, len(many), 256):
            rows = many[at : at + 256]
            some, last = scores[rows], scores.shape[1] - k
            kth = np.partition(some, last, axis=1)[:, last]
            found[rows] = some >= (np.maximum(low[rows], kth) - 1e-9)[:, None]
            tied = np.flatnonzero(np.count_nonzero(found[rows], axis=1) > 4 * k)
            if len(tied):  # copies: the first columns are enough
                value, least = np.round(some[tied], 9), np.maximum(low[rows[tied]], np.round(kth[tied], 9))[:, None]
                equal = value == least
                found[rows[tied]] = (value > least) | (equal & (np.cumsum(equal, axis=1) <= k))
        row, col = np.nonzero(found)
        value = np.round(scores[row, col], 9)
        order = np.lexsort((col, -value, row))
        row, col, value = row[order], col[order], value[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        good = (place < k) & (value >= low[row])
        row, col, value, place = row[good], col[good], value[good], place[good]
        met, at = np.unique(row, return_inverse=True)
        new = np.full((len(met), k), -np.inf)
        new[at, place] = value
        self.top[queries[met]] = np.sort(np.concatenate([self.top[queries[met]], new], axis=1), axis=1)[:, k:]
        return row, col

    def still(self, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Whether scores that were taken before may be hits still."""
        return np.round(scores, 9) >= self.top[queries].min(axis=1)


def batch_cosine_topk(
    candidates: DataFrame, vec_col: str, id_col: str, queries: DataFrame, query_id: str, query_vec: str, k: int,
) -> DataFrame:
    """Per query: top ``k`` candidates by cosine (query_id, rank, id, score)."""
    q = queries.filter(F.col(query_vec).isNotNull()).select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_query"))
    c = candidates.filter(F.col(vec_col).isNotNull()).select(id_col, vec_col)
    # Numbers of blocks as scalar subqueries: no driver round trip.
    n_q = F.coalesce(q.agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK)).scalar(), F.lit(1))
    n_c = F.coalesce(c.agg(F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK)).scalar(), F.lit(1))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        sized = df.withColumn("_nq", F.greatest(n_q, F.lit(1))).withColumn("_nc", F.greatest(n_c, F.lit(1)))
        sized = sized.withColumn(own, F.pmod(F.xxhash64(key), F.col("_nq" if own == "_qb" else "_nc")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nq" if other == "_qb" else "_nc") - 1))
        return sized.withColumn(other, every).drop("_nq", "_nc")

    fields = {f.name: f.dataType for f in [*candidates.schema.fields, *queries.schema.fields]}
    id_type, qid_type = candidates.schema[id_col].dataType, fields[query_id]
    fn = score_blocks(k, id_col, vec_col, to_arrow_type(id_type), to_arrow_type(qid_type))
    scored = (
        dealt(q, "query_id", "_qb", "_cb").groupBy("_qb", "_cb")
        .cogroup(dealt(c, id_col, "_cb", "_qb").groupBy("_qb", "_cb"))
        .applyInArrow(fn, f"query_id {qid_type.simpleString()}, {id_col} {id_type.simpleString()}, _score double")
    )
    w = Window.partitionBy("query_id").orderBy(F.round("_score", 9).desc(), F.col(id_col))
    return (
        scored.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", id_col, F.round("_score", 6).alias("score"))
    )
