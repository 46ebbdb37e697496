"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

A text's features are the distinct n-grams of ``LEAST`` to ``MOST`` characters of its
lower-cased form (a blank at either end), known by a 64-bit hash. On a sample of
labelled texts Spark counts in how many toxic and clean texts each n-gram stands. The
``FEATURES`` n-grams whose counts depend most on the label (likelihood ratio) are kept,
each with its naive Bayes log-count ratio: the log of its share of the toxic counts
over its share of the clean ones, both smoothed by ``SMOOTH``. A logistic regression is
then trained in numpy on the presence of these n-grams times their ratios, and its
intercept is moved to the share of toxic labels among all labelled rows.

Training data: at most ``DOCS_PER_CLASS`` documents of each label, those with the
smallest hashes of doc_id, with their whole texts; counts of labels use all labelled
rows. Only counted n-grams and the sample's feature numbers reach the driver. Scoring
reads every character of every text, a long one in stretches.

Defined results: null texts count as empty, and an empty text gets the intercept's
score; a document with both labels counts as toxic; labels that are null or not 0 or 1
and rows without a doc_id teach nothing; of repeated rows of a doc_id the smallest text
is learned from, and each row gets a score. If a label is missing from the training
rows, every score is the share of toxic labels (0 if there are none). An empty table
gives no rows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvelake.llm.common import fresh_column, ship
from cvelake.session import stage

LEAST, MOST = 3, 5
DOCS_PER_CLASS = 1500
FEATURES = 20_000
#: N-grams of fewer sample texts than this aren't features.
SUPPORT = 3
SMOOTH = 1.0
PENALTY = 1e-3
STEPS = 150
RATE = 0.05
SEED = 12
#: Characters hashed at once.
STRETCH = 1_000_000
#: Distinct n-grams that a task holds before it sends their counts on.
HELD = 1_000_000
FILTER_BITS = 22
#: Tasks that the bounded sample is dealt to.
PARTS = 48

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams of a text, repeated ones too, in several arrays."""
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(chars), STRETCH):
        # The next stretch's n-grams begin behind this one's.
        part = chars[start : start + STRETCH + MOST - 1].astype(np.uint64)
        sums = part
        for n in range(2, MOST + 1):
            sums = sums[: len(part) - n + 1] * _BASE + part[n - 1 :]
            if n >= LEAST and len(sums):
                own = sums[:STRETCH]
                yield (own ^ (own >> np.uint64(32))) * _MIX


def distinct(text: str) -> np.ndarray:
    found = [np.unique(h) for h in hashes(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


@dataclasses.dataclass
class Model:
    """``keys`` are the features' hashes in ascending order, ``weights`` what the
    presence of each adds to the log odds."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def filter(self) -> np.ndarray:
        """Which leading bits some feature has; most n-grams fail here."""
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[self.keys >> np.uint64(64 - FILTER_BITS)] = True
        return bits

    def features(self, text: str, bits: np.ndarray) -> np.ndarray:
        """Numbers of the features that a text has, ascending."""
        found = []
        for own in hashes(text):
            own = own[bits[own >> np.uint64(64 - FILTER_BITS)]]
            at = np.searchsorted(self.keys, own)
            at[at == len(self.keys)] = 0
            found.append(at[self.keys[at] == own] if len(self.keys) else at[:0])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def log_odds(self, text: str, bits: np.ndarray) -> float:
        return float(self.weights[self.features(text, bits)].sum() + self.bias)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))


def regression(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, penalty: float = PENALTY, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """(weight of each scaled feature, intercept) by full-batch gradient steps with
    moments; ``rows`` hold the feature numbers of each text."""
    at = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, bias = np.zeros(len(ratios)), 0.0
    first, second = np.zeros(len(ratios) + 1), np.zeros(len(ratios) + 1)
    for step in range(1, steps + 1):
        p = sigmoid(np.bincount(text, (w * ratios)[at], len(labels)) + bias)
        error = (p - labels) / len(labels)
        gradient = np.append(np.bincount(at, error[text], len(ratios)) * ratios + penalty * w, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of toxic and clean texts by n-gram, added up within the task."""

    def added(parts):
        keys, place = np.unique(np.concatenate([k for k, _, _ in parts]), return_inverse=True)
        return keys, *(np.bincount(place, np.concatenate([p[i] for p in parts]), len(keys)).astype(np.int64) for i in (1, 2))

    def out(parts):
        keys, toxic, clean = added(parts)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(clean)], names=["gram", "toxic", "clean"])

    parts, size = [], 0
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            keys = distinct(text or "")
            parts.append((keys, np.full(len(keys), toxic), np.full(len(keys), 1 - toxic)))
            size += len(keys)
            if size > 4 * HELD:
                parts = [added(parts)]
                size = len(parts[0][0])
                if size > HELD:
                    yield out(parts)
                    parts, size = [], 0
    if size:
        yield out(parts)


def sample(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """(text and label of a bounded number of documents that aren't held out, number
    of labelled documents by label)."""
    marked = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    may = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = stage(may.select("doc_id").distinct().join(marked, "doc_id"), "toxicity_labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    key = F.xxhash64("doc_id", F.lit(SEED))
    few = [known.filter(F.col("toxic") == c).orderBy(key, "doc_id").limit(docs_per_class) for c in (0, 1)]
    # At most 2 * docs_per_class ids.
    chosen = F.broadcast(few[0].unionAll(few[1]))
    rows = may.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), totals


def fit(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS, features: int = FEATURES) -> Model:
    """A model learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    ship(docs.sparkSession)
    chosen, totals = sample(docs, labels, docs_per_class)
    n = [totals.get(0, 0), totals.get(1, 0)]
    if not min(n):
        share = n[1] / max(1, sum(n))
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.inf if share == 1 else -np.inf))
    chosen = stage(chosen, "toxicity_sample")
    size = [min(docs_per_class, x) for x in n]
    spread = chosen.repartition(PARTS, "doc_id").select("text", "toxic")
    counted = spread.mapInArrow(_count, "gram long, toxic long, clean long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = stage(counted.filter(F.col("toxic") + F.col("clean") >= SUPPORT), "toxicity_counts")
    total = counted.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    gain = lambda c, m: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / ((F.col("toxic") + F.col("clean")) * m / sum(size)))).otherwise(0.0)
    best = counted.orderBy((gain("toxic", size[1]) + gain("clean", size[0])).desc(), "gram").limit(features)
    rows = best.collect()
    keys = np.array([r["gram"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    toxic, clean = (np.array([r[c] for r in rows], np.float64)[order] for c in ("toxic", "clean"))
    share = lambda x, c: (x + SMOOTH) / ((total[c] or 0) + SMOOTH * total["n"])
    ratios = np.log(share(toxic, "toxic") / share(clean, "clean"))
    model = Model(keys[order], np.zeros(len(rows)), 0.0)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.filter()
        for batch in batches:
            found = [model.features(t, bits).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())], names=["doc_id", "toxic", "found"])

    made = chosen.repartition(PARTS, "doc_id").mapInArrow(vectors, T.StructType([chosen.schema["doc_id"], chosen.schema["toxic"], T.StructField("found", T.BinaryType())]))
    # At most 2 * docs_per_class rows of at most ``features`` numbers.
    learned = sorted(made.collect(), key=lambda r: r["doc_id"])
    w, bias = regression([np.frombuffer(r["found"], "<i4") for r in learned], np.array([r["toxic"] for r in learned], np.float64), ratios)
    return Model(model.keys, w * ratios, bias + float(np.log(n[1] / n[0]) - np.log(size[1] / size[0])))


def score(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """``docs`` with the probability of being toxic, and the name of that column."""
    ship(docs.sparkSession)
    name = fresh_column(docs, "toxicity")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = model.filter()
        for batch in batches:
            texts = batch.column("text")
            odds = [model.log_odds(texts[i].as_py() or "", bits) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(odds), pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])), name
