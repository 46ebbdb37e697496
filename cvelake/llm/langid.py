"""Language ID by a bidirectional gated recurrent network over bytes.

Texts become runs of letters (A-Z as a-z, bytes of other alphabets as they are) with
one blank between them, cut into pieces of ``PIECE`` bytes. Two gated recurrent
layers read each piece from either end; their states at a byte give that byte's
label probabilities, and a document's probabilities are the mean over all its bytes.
The network is trained in numpy, by backpropagation through time, on a bounded
sample of labelled rows; prediction runs over every byte of every text.

Training data: at most ``DOCS_PER_LABEL`` documents for each of the ``MOST_LABELS``
most frequent labels, those with the smallest hashes, and ``PIECES_PER_DOC`` evenly
spaced pieces of each. Seeds are fixed, so results repeat.

Arrays hold features in rows and pieces in columns: the recurrence works on
contiguous vectors of all pieces of a batch.

Defined results: null texts and texts without a letter are ``und`` with score 0, as
is everything if there is nothing to learn from; rows without a doc_id are not
learned from and not held out; an empty table gives no rows; repeated rows each get
a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvelake.llm.common import fresh_column, ship, slices
from cvelake.llm.tokens import forget

PIECE = 64
STATES = 8
DOCS_PER_LABEL = 400
MOST_LABELS = 200
PIECES_PER_DOC = 4
STEPS = 400
BATCH = 256
RATE = 0.02
SEED = 7
#: Pieces of one pass; sized for the processor's cache.
COLUMNS = 4096
SALTS = 64
#: Steps between 0 and 1 in which a table's scores are counted.
SCORE_STEPS = 10_000

_LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Symbols: 0 padding, 1 blank, then letters and the upper half of the byte range.
_SYMBOLS = np.zeros(256, np.uint8)
_SYMBOLS[[0x20, *range(0x61, 0x7B), *range(0x80, 0x100)]] = np.arange(1, 156)
SYMBOLS = 156


def letters_of(text: str) -> bytes:
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by place and piece, pieces of each text)."""
    counts = np.array([-(-len(t) // PIECE) for t in texts], np.int64)
    padded = b"".join(t + bytes(-len(t) % PIECE) for t in texts)
    return np.ascontiguousarray(_SYMBOLS[np.frombuffer(padded, np.uint8)].reshape(-1, PIECE).T), counts


class Network:
    """Two gated recurrent layers, of ``states`` each, and a label layer on both.

    Parameters of a layer: ``w`` (3 * states, symbols) and ``u`` (3 * states,
    states), rows in the order update, reset, candidate; biases are part of ``w``,
    which has a column for every symbol."""

    def __init__(self, labels: list[str], states: int = STATES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels, self.states = labels, states
        small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.weights = {}
        for side in ("ahead", "back"):
            self.weights |= {f"w_{side}": small(3 * states, SYMBOLS), f"u_{side}": small(3 * states, states)}
            self.weights[f"o_{side}"] = small(len(labels), states)
        self.weights["bias"] = np.zeros((len(labels), 1), np.float32)

    def _read(self, symbols: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States of one layer at every place, (place, state, piece)."""
        h, (steps, n) = self.states, symbols.shape
        # tanh of the half serves as the sigmoid, so the gates' halves go into the weights.
        half = np.concatenate([np.full(2 * h, 0.5), np.ones(h)]).astype(np.float32)[:, None]
        w, u = np.ascontiguousarray(self.weights[f"w_{side}"] * half), self.weights[f"u_{side}"] * half
        states = np.empty((steps, h, n), np.float32)
        now, g = np.zeros((h, n), np.float32), np.empty((3 * h, n), np.float32)
        for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
            a = np.take(w, symbols[t], axis=1)
            np.matmul(u, now, out=g)
            gates, candidate, inner = a[: 2 * h], a[2 * h :], g[2 * h :]
            gates += g[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            if keep is not None:
                keep.append((t, now.copy(), inner.copy(), gates, candidate))
            inner *= gates[h:]
            candidate += inner
            np.tanh(candidate, out=candidate)
            now -= candidate
            now *= gates[:h]
            now += candidate
            states[t] = now
        return states

    def _labels(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Label probabilities at one place or several, (..., label, piece)."""
        scores = np.matmul(self.weights["o_ahead"], ahead) + np.matmul(self.weights["o_back"], back) + self.weights["bias"]
        scores -= scores.max(axis=-2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=-2, keepdims=True)
        return scores

    def piece_sums(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the label probabilities over a piece's bytes, number of bytes)."""
        ahead, back = self._read(symbols, "ahead"), self._read(symbols, "back")
        total = np.zeros((len(self.labels), symbols.shape[1]), np.float32)
        for t in range(len(symbols)):
            p = self._labels(ahead[t], back[t])
            p *= symbols[t] > 0
            total += p
        return total, (symbols > 0).sum(axis=0)

    def document_means(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Mean label probabilities of each document, (document, label)."""
        sums, sizes = [], []
        for first in range(0, symbols.shape[1], COLUMNS):
            s, n = self.piece_sums(np.ascontiguousarray(symbols[:, first : first + COLUMNS]))
            sums.append(s)
            sizes.append(n)
        starts = np.cumsum(counts) - counts
        total = np.add.reduceat(np.concatenate(sums, axis=1).astype(np.float64), starts, axis=1)
        return (total / np.add.reduceat(np.concatenate(sizes), starts)).T

    def gradients(self, symbols: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all bytes, and its gradients, by backpropagation through time."""
        h, (steps, n), w = self.states, symbols.shape, self.weights
        kept: dict[str, list] = {"ahead": [], "back": []}
        states = {side: self._read(symbols, side, kept[side]) for side in kept}
        p = self._labels(states["ahead"], states["back"])
        there = (symbols > 0).astype(np.float32)
        total = there.sum()
        true = p[:, labels, np.arange(n)]
        loss = float(-(np.log(np.maximum(true, 1e-9)) * there).sum() / total)
        d = p
        d[:, labels, np.arange(n)] -= 1
        d *= there[:, None, :] / total
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["bias"] = d.sum(axis=(0, 2))[:, None]
        for side in kept:
            u = w[f"u_{side}"]
            grads[f"o_{side}"] = np.einsum("tln,thn->lh", d, states[side])
            down = np.zeros((h, n), np.float32)
            for t, before, inner, gates, candidate in reversed(kept[side]):
                down += w[f"o_{side}"].T @ d[t]
                z, r = gates[:h], gates[h:]
                d_candidate = down * (1 - z) * (1 - candidate**2)
                d_z = down * (before - candidate) * z * (1 - z)
                d_r = d_candidate * inner * r * (1 - r)
                gate_inputs = np.concatenate([d_z, d_r, d_candidate])
                state_inputs = np.concatenate([d_z, d_r, d_candidate * r])
                seen = np.zeros((SYMBOLS, n), np.float32)
                seen[symbols[t], np.arange(n)] = 1
                grads[f"w_{side}"] += gate_inputs @ seen.T
                grads[f"u_{side}"] += state_inputs @ before.T
                down = down * z + u.T @ state_inputs
        return loss, grads

    def train(self, symbols: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            while len(order) < min(batch, len(labels)):
                order = np.concatenate([order, rng.permutation(len(labels))])
            own, order = order[:batch], order[batch:]
            _, grads = self.gradients(np.ascontiguousarray(symbols[:, own]), labels[own])
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            pace = rate * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                g = g / max(1.0, norm)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.weights[k] = (self.weights[k] - pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame, docs_per_label: int = DOCS_PER_LABEL, most_labels: int = MOST_LABELS) -> list[tuple[str, str]]:
    """(label, text) of a bounded number of labelled rows that aren't held out."""
    ship(docs.sparkSession)
    may = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    keys = may.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(SEED)).alias("key"))
    labels = keys.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labels).select("lang")
    # A label may have a third of all rows, so its smallest keys are found in two steps.
    by_salt = Window.partitionBy("lang", "salt").orderBy("key", "doc_id")
    few = keys.withColumn("salt", F.pmod("key", F.lit(SALTS))).withColumn("rank", F.row_number().over(by_salt)).filter(F.col("rank") <= docs_per_label)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    chosen = few.withColumn("rank", rank).filter(F.col("rank") <= docs_per_label).join(labels, "lang", "left_semi").select("doc_id").distinct()
    # At most docs_per_label * most_labels ids.
    found = may.filter(has_letter(F.col("text"))).join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "lang", "text")
    spread = F.udf(lambda text: _spread(text), "string")
    rows = found.select("doc_id", "lang", spread("text").alias("text")).limit(2 * docs_per_label * most_labels).collect()
    return [(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["lang"], r["text"]))]


def _spread(text: str) -> str:
    """Evenly spaced stretches of a text, enough for its training pieces."""
    size = 4 * PIECE
    starts = {int(x) for x in np.linspace(0, max(0, len(text) - size), PIECES_PER_DOC)} if len(text) > size * PIECES_PER_DOC else None
    return text if starts is None else " ".join(text[s : s + size] for s in sorted(starts))


def fit(rows: list[tuple[str, str]], **options) -> Network | None:
    """A network trained on (label, text) rows; None if there is nothing to learn."""
    labels = sorted({label for label, _ in rows})
    pieces, targets = [], []
    for label, text in rows:
        data = letters_of(text)
        if not data:
            continue
        symbols, _ = pieces_of([data])
        at = np.unique(np.linspace(0, symbols.shape[1] - 1, PIECES_PER_DOC).astype(int))
        pieces.append(symbols[:, at])
        targets += [labels.index(label)] * len(at)
    if not pieces:
        return None
    network = Network(labels)
    network.train(np.concatenate(pieces, axis=1), np.array(targets), **options)
    return network


def least_score(network: Network, rows: list[tuple[str, str]]) -> float:
    """A bound below which a score says that a text is in none of the labels' languages:
    a third of the way from chance (one over the number of labels) to the score that
    all but a hundredth of the training rows reach. It so follows the number of labels
    and how sure the network is of its own sample."""
    data = [x for _, text in rows if (x := letters_of(text))]
    chance = 1 / len(network.labels)
    sure = float(np.quantile(network.document_means(*pieces_of(data)).max(axis=1), 0.01))
    return chance + max(0.0, sure - chance) / 3


def least_score_of(found: DataFrame, network: Network, lang: str, score: str) -> float:
    """The same bound from a whole table's predictions: what all but a hundredth of its
    labelled rows with a letter reach, to a ``SCORE_STEPS``-th."""
    labelled = found.filter(F.col("lang").isNotNull() & (F.col(lang) != "und"))
    # At most SCORE_STEPS + 1 rows.
    steps = labelled.groupBy(F.floor(F.col(score) * SCORE_STEPS).alias("step")).count().orderBy("step").collect()
    chance, below = 1 / len(network.labels), 0
    most = sum(r["count"] for r in steps) / 100
    for r in steps:
        below += r["count"]
        if below > most:
            return chance + max(0.0, r["step"] / SCORE_STEPS - chance) / 3
    return chance


def _predict(network: Network, letter: str, kept: list[str], names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts, good = batch.column("text"), batch.column(letter).to_pylist()
            langs, scores = [], []
            for low, high in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                rows = texts.slice(low, high - low).to_pylist()
                data = [letters_of(t) if g else b"" for t, g in zip(rows, good[low:high], strict=True)]
                asked = [i for i, x in enumerate(data) if x]
                lang, score = ["und"] * len(rows), [0.0] * len(rows)
                if asked:
                    means = network.document_means(*pieces_of([data[i] for i in asked]))
                    for i, best, p in zip(asked, means.argmax(axis=1).tolist(), means.max(axis=1).tolist(), strict=True):
                        lang[i], score[i] = network.labels[best], min(1.0, p)
                langs += lang
                scores += score
            columns = [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return run


def predict(docs: DataFrame, network: Network | None, keep: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """``docs`` (or its columns ``keep``) with a predicted label and its probability,
    and the names of those two columns."""
    ship(docs.sparkSession)
    kept = docs.columns if keep is None else keep
    names = (fresh_column(docs, "lang_pred"), fresh_column(docs, "score"))
    if network is None:
        return docs.select(*[f"`{c}`" for c in kept], F.lit("und").alias(names[0]), F.lit(0.0).alias(names[1])), *names
    letter = fresh_column(docs, "has_letter")
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, "text"])], has_letter(F.col("text")).alias(letter))
    return read.mapInArrow(_predict(network, letter, kept, names), schema), *names
