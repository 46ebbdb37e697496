"""Benchmark decontamination by pigeonhole edit matching.

A test item may stand in a text with up to ``budget`` edits (a share of its length).
It is split into budget + 1 pieces; with that few edits one piece must stand
unchanged. An Aho-Corasick automaton finds all exact piece hits in one pass over a
text, and Myers' bit-parallel edit distance verifies them: the pieces are the
leaves of a binary split whose nodes share the budget (a half of an item within b
edits is within b // 2 edits, or the other half is within b - b // 2 - 1), so a
hit climbs from its leaf to the whole item and most false hits end after one short
node. No occurrence within the budget is missed.

Items are normalized in tasks, written to the shared folder and dealt to blocks of
about ``BLOCK_CHARS`` characters; driver and tasks hold one block at a time. With a
single block, which most benchmarks are, the matches are one more column of the texts,
which don't move. With more, the rows are written with a number, each block is a pass
over them of which only the matches are written, and these are joined at the end.

Texts and items are compared in lower case with every run of ASCII characters other
than letters and digits as one blank; spans are positions in that form.

Defined results: null and empty texts match nothing; items with fewer than
``LEAST_WORDS`` words (an argument of ``matches``), and fewer than ``LEAST_LETTERS``
letters of scripts that put no blanks between words, are no test passages and match
nothing (``left_out`` lists them); a repeated item
matches under each of its ids, a null item_id is left out; an empty benchmark
leaves all texts clean; an empty table gives no rows. The column ``matches`` gets
another name if the table has one of that name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvelake.llm.common import fresh_column, ship
from cvelake.llm.tokens import forget
from cvelake.session import stage

#: Edits allowed, as a share of an item's characters.
EDIT_RATE = 0.08
LEAST_WORDS = 5
#: Letters that count as a passage where no blanks part the words.
LEAST_LETTERS = 20
#: Characters of the items that one pass looks for.
BLOCK_CHARS = 1_000_000

_MATCH = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"
_SIGNS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


#: Thai, Lao, Tibetan, Myanmar, Khmer, Tai scripts, Chinese and Japanese.
_NO_BLANKS = re.compile("[\u0e00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def is_passage(item: str, least_words: int = LEAST_WORDS) -> bool:
    """Whether a normalized item is long enough to be looked for."""
    return item.count(" ") + 1 >= least_words or len(_NO_BLANKS.findall(item)) >= LEAST_LETTERS


def normalize(text: str) -> str:
    words = text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split()
    return b" ".join(words).decode("utf-8", "surrogatepass")


def split(start: int, end: int, budget: int) -> list[list[tuple[int, int, int]]]:
    """For each piece its path (start, end, budget) from the leaf up to the whole."""
    if budget == 0:
        return [[(start, end, 0)]]
    left = budget // 2
    middle = start + (end - start) * (left + 1) // (budget + 1)
    halves = split(start, middle, left) + split(middle, end, budget - left - 1)
    return [[*path, (start, end, budget)] for path in halves]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def nearest(pattern: dict[str, int], length: int, text: str, enough: int = -1) -> tuple[int, int]:
    """(smallest edit distance of the pattern to any substring of ``text``, that
    substring's end); stops at a distance of ``enough`` or less."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for at, c in enumerate(text):
        same = pattern.get(c, 0)
        vertical = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up = minus | ~(across | plus)
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, at + 1
                if best <= enough:
                    break
        up <<= 1
        plus = ((down << 1) | ~(vertical | up)) & full
        minus = up & vertical & full
    return best, end


class Finder:
    """The items of one block, ready to be found in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = items
        self.automaton = ahocorasick.Automaton()
        self.nodes: dict[tuple[int, int, int], dict[str, int]] = {}
        owners: dict[str, list[tuple[int, list]]] = {}
        for n, (_, text) in enumerate(items):
            for path in split(0, len(text), budget_of(text)):
                piece = text[path[0][0] : path[0][1]]
                owners.setdefault(piece, []).append((n, path))
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def _node(self, n: int, start: int, end: int) -> dict[str, int]:
        key = (n, start, end)
        if key not in self.nodes:
            self.nodes[key] = masks(self.items[n][1][start:end])
        return self.nodes[key]

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the nearest occurrence of each item."""
        if not len(self.automaton):
            return []
        tried: set[tuple[int, int]] = set()
        found: dict[int, tuple[int, int, int]] = {}
        for last, (length, owners) in self.automaton.iter(text):
            first = last - length + 1
            for n, path in owners:
                diagonal = first - path[0][0]
                if (n, diagonal) in tried or (n in found and found[n][0] == 0):
                    continue
                for start, end, budget in path[1:]:
                    low = max(0, diagonal + start - budget)
                    window = text[low : diagonal + end + budget]
                    is_item = end - start == len(self.items[n][1])
                    best, at = nearest(self._node(n, start, end), end - start, window, 0 if is_item else budget)
                    if best > budget:
                        break
                else:
                    tried.add((n, diagonal))
                    start, end, budget = path[-1]
                    if len(path) == 1:
                        low, best, at = first, 0, length
                    if n not in found or best < found[n][0]:
                        found[n] = (best, *self._span(n, text, low + at, best))
        return sorted((self.items[n][0], d, s, e) for n, (d, s, e) in found.items())

    def _span(self, n: int, text: str, end: int, distance: int) -> tuple[int, int]:
        item = self.items[n][1]
        low = max(0, end - len(item) - distance)
        _, length = nearest(masks(item[::-1]), len(item), text[low:end][::-1], distance)
        return end - length, end


def budget_of(text: str, rate: float = EDIT_RATE) -> int:
    return math.floor(len(text) * rate)


def _find(items: list[tuple[int, str]], text_column: str, out: str, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        finder = Finder(items)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        names = ("item_id", "distance", "start", "end")
        for batch in batches:
            rows = []
            for text in batch.column(text_column):
                value = text.as_py()
                rows.append([dict(zip(names, m, strict=True)) for m in finder.find(normalize(value))] if value else [])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(rows, kind)], names=[*kept, out])

    return run


def items_of(benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(item_id, item: normalized text, passage: whether it is looked for)."""
    ship(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [normalize(t) for t in batch.column("text").to_pylist()]
            good = pa.array([is_passage(i, least_words) for i in items], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(items, pa.string()), good], names=["item_id", "item", "passage"])

    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null and text is not null")
    return known.mapInArrow(run, "item_id long, item string, passage boolean")


def left_out(benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The item_ids of a benchmark that are too short to be looked for."""
    return items_of(benchmark, least_words).filter(~F.col("passage")).select("item_id")


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", least_words: int = LEAST_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with a column of matches (item_id, distance, start, end) by item_id, and
    its name."""
    ship(docs.sparkSession)
    out = fresh_column(docs, "matches")
    kind = T.StructField(out, T._parse_datatype_string(_MATCH))
    items = stage(items_of(benchmark, least_words).filter("passage").drop("passage"), "benchmark_items")
    size = items.agg(F.sum(F.length("item"))).first()[0]
    if not size:
        return docs.withColumn(out, F.array().cast(_MATCH)), out
    blocks = 1 + size // BLOCK_CHARS
    block_of = F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks))
    block = lambda b: [tuple(r) for r in items.filter(block_of == b).orderBy("item_id", "item").collect()]
    if blocks == 1:
        return docs.mapInArrow(_find(block(0), text, out, docs.columns), T.StructType([*docs.schema.fields, kind])), out
    uid = fresh_column(docs, "uid")
    rows = stage(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered_texts")
    read = rows.select(uid, text)
    found = None
    for b in range(blocks):
        own = read.mapInArrow(_find(block(b), text, out, [uid]), T.StructType([read.schema[uid], kind]))
        own = stage(own.filter(F.size(out) > 0), f"matches_{b}")
        found = own if found is None else found.unionAll(own)
    found = found.groupBy(uid).agg(F.array_sort(F.flatten(F.collect_list(out))).alias(out))
    joined = rows.join(found, uid, "left").withColumn(out, F.coalesce(out, F.array().cast(_MATCH)))
    return joined.drop(uid), out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no test item stands."""
    found, out = matches(docs, benchmark)
    return found.filter(F.size(F.col(out)) == 0).drop(out)
