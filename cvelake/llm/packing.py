"""Best-fit packing of tokenized documents into sequences of bounded length.

Method: bounded-space online best-fit. Each task reads its documents in order
and keeps a fixed number of open bins, indexed by a bitset keyed by free space:
bit f is set if some open bin has f tokens left, so the best fit for a piece of
n tokens is the lowest set bit at n or above. If nothing fits, a new bin opens;
beyond the fixed number, the fullest open bin closes for good. Placement needs no
shuffle. A task's bins that are still open at its end, a bounded number per task,
are packed once more as whole units, so that many small tasks don't leave many
half-empty sequences.

Defined results: a null or empty text is a document of its end id alone; a null
doc_id or a repeated row is packed like any other row; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvelake.llm.common import ship, slices, text_or_empty
from cvelake.llm.tokens import CACHE_CHUNKS, tokenizer
from cvelake.session import stage

#: Open bins of one task.
OPEN_BINS = 512
#: Tasks whose left-over bins are packed together again.
TASKS_PER_REPACK = 64
#: Sequence ids of one task start at its partition number times this.
TASK_SPAN = 1 << 33

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
_MOVES = "old_sequence long, new_sequence long, base long"

class OpenBins:
    """At most ``limit`` bins that still take pieces, found by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.count = 0
        self.bits = 0
        self.by_free: dict[int, list] = {}
        self.next = 0

    def _put(self, free: int, bin_id) -> None:
        self.by_free.setdefault(free, []).append(bin_id)
        self.bits |= 1 << free
        self.count += 1

    def _take(self, free: int):
        same = self.by_free[free]
        bin_id = same.pop()
        if not same:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.count -= 1
        return bin_id

    def place(self, length: int) -> tuple[int, int, list[int]]:
        """(bin, offset in it, bins that closed) for a piece of ``length``."""
        fitting = self.bits >> length
        closed = []
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            self._put(left, bin_id)
        else:
            closed.append(bin_id)
        if self.count > self.limit:
            fullest = (self.bits & -self.bits).bit_length() - 1
            closed.append(self._take(fullest))
        return bin_id, free, closed

    def remaining(self) -> set[int]:
        return {b for same in self.by_free.values() for b in same}

def _pack_documents(path: str, drops_space: bool, end_id: int, capacity: int, open_bins: int, cache_chunks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() * TASK_SPAN
        waiting: dict[int, list[tuple]] = {}  # rows of the open bins
        encoder = tokenizer(path, drops_space, cache_chunks)
        end = np.array([end_id], np.uint32)

        def rows(found: list[tuple], is_open: bool) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[]] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            data = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*data, pa.array([is_open] * len(found), pa.bool_())], names=names)

        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")

            sizes = pc.binary_length(texts).to_pylist()
            for low, high in slices(sizes):
                done = []
                ids, counts = encoder.encode(texts.slice(low, high - low).to_pylist())
                at = 0
                for doc_id, n in zip(doc_ids[low:high], counts.tolist(), strict=True):
                    own = np.concatenate([ids[at : at + n], end]).astype("<u4")
                    at += n
                    for piece, start in enumerate(range(0, n + 1, capacity)):
                        part = own[start : start + capacity]
                        where, free, closed = bins.place(len(part))
                        row = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()), base + where, capacity - free)
                        waiting.setdefault(where, []).append(row)
                        for bin_id in closed:
                            done += waiting.pop(bin_id)
                yield rows(done, False)
        yield rows([r for own in waiting.values() for r in own], True)

    return run

def _repack(capacity: int):
    """Joins left-over bins (old sequence, tokens in it), fullest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = []
        for batch in batches:
            units += zip(batch.column("used").to_pylist(), batch.column("old_sequence").to_pylist(), strict=True)
        bins, first, out = OpenBins(capacity, len(units) + 1), {}, []
        for used, old in sorted(units, key=lambda u: (-u[0], u[1])):
            where, free, _ = bins.place(used)
            out.append((old, first.setdefault(where, old), capacity - free))
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["old_sequence", "new_sequence", "base"])

    return run

def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 4096,
    drops_space: bool = True,
    open_bins: int = OPEN_BINS,
    tasks_per_repack: int = TASKS_PER_REPACK,
    cache_chunks: int = CACHE_CHUNKS,
) -> DataFrame:
    """``docs`` (doc_id, text) as pieces in sequences of at most ``capacity`` ids.

    Each document is its ids and ``end_id``; only longer ones are cut. ``cache_chunks``
    bounds what a worker remembers of the tokenization (less memory, more time, the
    same ids). Returns per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ship(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    placed = stage(
        read.mapInArrow(_pack_documents(tokenizer_path, drops_space, end_id, capacity, open_bins, cache_chunks), _PIECES), "packed"
    )
    # The left-over bins number at most open_bins per task; each group of tasks
    # packs its own again, so no task gets more than a fixed number of them.
    left = placed.filter("open").groupBy(F.col("sequence_id").alias("old_sequence")).agg(F.sum("length").alias("used"))
    group = F.expr(f"old_sequence div {TASK_SPAN * tasks_per_repack}")
    moves = left.withColumn("group", group).groupBy("group").applyInArrow(_whole(_repack(capacity)), _MOVES)
    closed = placed.filter("not open").drop("open")
    opened = (
        placed.filter("open")
        .drop("open")
        .join(moves, F.col("sequence_id") == F.col("old_sequence"))
        .withColumn("sequence_id", F.col("new_sequence"))
        .withColumn("offset", F.col("offset") + F.col("base"))
        .select(closed.columns)
    )
    return closed.unionByName(opened)

def _whole(run):
    def of_table(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(iter(group.to_batches())))

    return of_table
