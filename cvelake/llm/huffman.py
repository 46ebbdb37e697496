"""Token ids as canonical length-limited Huffman codes in independent blocks.

Writing: texts become ids, ids are counted over the whole corpus, package-merge
gives the code lengths (at most ``MAX_BITS``), and canonical codes follow from the
lengths alone. A document's bits start on a byte, so documents are encoded where
they lie and only their bits move: parts of the doc_id range are sorted, and
whole documents are joined to blocks of about ``BLOCK_IDS`` ids.

Files under the output folder (Parquet, so that they can be on any store):
``code`` (id, bits) and ``blocks`` (part, block, n_ids, doc_ids, doc_sizes,
checkpoints, payload). Parts and, in them, blocks ascend by doc_id; ``checkpoints``
holds the bit offset in the payload of every ``LANE_IDS``-th id of each document,
little-endian 64 bits each. A block needs nothing but the code to be read.

Reading: a table of 2^bits entries gives the id and the length of the code that
starts with those bits; all lanes between checkpoints are decoded side by side.

Defined results: a null or empty text is its end id alone; null doc_ids come first;
rows with the same doc_id stand side by side, the shorter first; an empty table
gives empty files and no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cvelake.llm.common import ship, slices, text_or_empty
from cvelake.llm.tokens import tokenizer
from cvelake.session import scratch_dir

#: Longest code; more only if there are more than 2^16 ids.
MAX_BITS = 16
#: Ids between two checkpoints.
LANE_IDS = 256
#: A block closes after the document that brings it to so many ids.
BLOCK_IDS = 1 << 16
#: A part of the doc_id range holds about so many ids, whatever their number (a part
#: is sorted by Spark and read as a stream, so rows of a single doc_id may exceed it).
PART_IDS = 1 << 22
#: Percentiles taken at once; of more parts than that, percentiles of each range.
CUTS = 2000

_BLOCKS = "part int, block long, n_ids long, doc_ids array<long>, doc_sizes array<long>, checkpoints binary, payload binary"
_DECODED = "part int, block long, doc_id long, n_tokens long, ids_crc32 long, in_block long"


def code_lengths(weights: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``most`` bits (package-merge)."""
    n = len(weights)
    if n < 2:
        return np.ones(n, np.int64)
    most = max(most, int(n - 1).bit_length())
    order = np.argsort(weights, kind="stable")
    coins = weights[order].astype(np.int64)
    leaf_flags, merged = [], coins
    leaf_flags.append(np.ones(n, bool))
    for _ in range(most - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([coins, packages])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        leaf_flags.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(leaf_flags):
        leaves = int(flags[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id from the lengths alone: shorter first, then by position."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        code <<= int(lengths[i]) - before
        codes[i], before = code, int(lengths[i])
        code += 1
    return codes


def decode_table(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """(entry for every bit pattern: id * 64 + length, pattern width)."""
    width = int(lengths.max())
    order = np.lexsort((np.arange(len(lengths)), lengths))
    spans = 1 << (width - lengths[order])
    entries = ids[order].astype(np.int64) * 64 + lengths[order]
    table = np.repeat(entries, spans)
    return np.concatenate([table, np.full((1 << width) - len(table), entries[-1])]), width


def pack_bits(codes: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, n_bits: int) -> np.ndarray:
    """64-bit words (most significant bit first) with each code at its bit offset."""
    words = np.zeros(n_bits // 64 + 2, np.uint64)
    if not len(codes):
        return words
    at, bit = offsets >> 6, offsets & 63
    left = codes << (64 - lengths).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    words[at[first]] = np.bitwise_or.reduceat(left >> bit.astype(np.uint64), first)
    over = np.flatnonzero(bit + lengths > 64)
    words[at[over] + 1] |= left[over] << (64 - bit[over]).astype(np.uint64)
    return words


def _tokenize(path: str, drops_space: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path, drops_space)
        for batch in batches:
            texts = batch.column("text")
            for low, high in slices(pc.binary_length(texts).to_pylist()):
                ids, sizes = encoder.encode(texts.slice(low, high - low))
                ends = np.cumsum(sizes + 1)
                own = np.full(int(ends[-1]), end_id, np.uint32)
                is_id = np.ones(len(own), bool)
                is_id[ends - 1] = False
                own[is_id] = ids
                kind = "<u2" if own.max() < 1 << 16 else "<u4"
                width = np.dtype(kind).itemsize
                places = pa.py_buffer(np.concatenate([[0], ends * width]).astype("<i8"))
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), high - low, [None, places, pa.py_buffer(own.astype(kind))])
                columns = [batch.column("doc_id").slice(low, high - low), pa.array(sizes + 1, pa.int64()), data.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids"])

    return run


def _ids(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each id occurs in one task's documents."""
    total = np.zeros(1, np.int64)
    for batch in batches:
        counts = batch.column("n").to_pylist()
        for low, high in slices(counts, 1_000_000):
            rows = zip(batch.column("ids").slice(low, high - low).to_pylist(), counts[low:high], strict=True)
            own = np.bincount(np.concatenate([_ids(data, n) for data, n in rows]))
            if len(own) > len(total):
                total = np.concatenate([total, np.zeros(len(own) - len(total), np.int64)])
            total[: len(own)] += own
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "uses"])


def _encode(ids: np.ndarray, lengths: np.ndarray, bounds: list):
    """Each document to its own bits, starting on a byte."""
    codes = np.zeros(int(ids.max()) + 1, np.uint64)
    codes[ids] = canonical_codes(lengths)
    bits = np.zeros(len(codes), np.int64)
    bits[ids] = lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, counts = batch.column("doc_id"), batch.column("n").to_pylist()
            for low, high in slices(counts, 1_000_000):
                rows = batch.column("ids").slice(low, high - low).to_pylist()
                sizes = np.array(counts[low:high], np.int64)
                own = np.concatenate([_ids(x, n) for x, n in zip(rows, counts[low:high], strict=True)])
                wide = bits[own]
                ends = np.cumsum(wide)
                last = np.cumsum(sizes)
                doc_bits = np.diff(np.concatenate([[0], ends[last - 1]]))
                doc_bytes = (doc_bits + 7) // 8
                first_byte = np.cumsum(doc_bytes) - doc_bytes
                shift = 8 * first_byte - (ends[last - 1] - doc_bits)
                offsets = ends - wide + np.repeat(shift, sizes)
                data = pack_bits(codes[own], wide, offsets, int(8 * doc_bytes.sum())).astype(">u8").tobytes()
                marks = []
                for first, n, b in zip((last - sizes).tolist(), sizes.tolist(), first_byte.tolist(), strict=True):
                    marks.append((offsets[first : first + n : LANE_IDS] - 8 * b).astype("<u8").tobytes())
                cut = [data[b : b + n] for b, n in zip(first_byte.tolist(), doc_bytes.tolist(), strict=True)]
                keys = doc_ids.slice(low, high - low)
                part = np.searchsorted(bounds, keys.fill_null(0).to_numpy(zero_copy_only=False), side="left")
                part = np.where(keys.is_null().to_numpy(zero_copy_only=False), 0, part)
                columns = [pa.array(part, pa.int32()), keys, pa.array(sizes), pa.array(marks, pa.binary()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "n", "checkpoints", "payload"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents to blocks; a block never spans two parts."""
    part, number, rows, ids = None, 0, [], 0

    def block() -> pa.RecordBatch:
        base, marks = 0, []
        for _, _, checkpoints, payload in rows:
            marks.append((np.frombuffer(checkpoints, "<u8") + np.uint64(8 * base)).astype("<u8").tobytes())
            base += len(payload)
        values = [part, number, ids, [r[0] for r in rows], [r[1] for r in rows], b"".join(marks), b"".join(r[3] for r in rows)]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        names = ["part", "block", "n_ids", "doc_ids", "doc_sizes", "checkpoints", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != part:
                if rows:
                    yield block()
                part, number, rows, ids = row[0], 0, [], 0
            rows.append(row[1:])
            ids += row[2]
            if ids >= BLOCK_IDS:
                yield block()
                number, rows, ids = number + 1, [], 0
    if rows:
        yield block()


def decode_lanes(words: np.ndarray, starts: np.ndarray, steps: int, table: np.ndarray, width: int) -> np.ndarray:
    """(lane, step) ids; lanes run side by side from their start bits."""
    out = np.empty((steps, len(starts)), np.uint32)
    at, last, down = starts.astype(np.int64), len(words) - 2, np.uint64(64 - width)
    one, most = np.uint64(1), np.uint64(63)
    for step in range(steps):
        word = np.minimum(at >> 6, last)
        bit = (at & 63).astype(np.uint64)
        view = (words[word] << bit) | ((words[word + 1] >> one) >> (most - bit))
        entry = table[(view >> down).astype(np.int64)]
        out[step] = entry >> 6
        at += entry & 63
    return out.T


def _decode(ids: np.ndarray, lengths: np.ndarray):
    table, width = decode_table(ids, lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("n_ids").to_pylist(), 1_000_000):
                rows = batch.slice(low, high - low).to_pylist()
                words, starts, used, base = [], [], [], 0
                for r in rows:
                    payload = r["payload"] + bytes(8 + -len(r["payload"]) % 8)
                    words.append(np.frombuffer(payload, ">u8").astype(np.uint64))
                    starts.append(np.frombuffer(r["checkpoints"], "<u8").astype(np.int64) + 64 * base)
                    base += len(words[-1])
                    for n in r["doc_sizes"]:
                        used += [LANE_IDS] * (n // LANE_IDS) + [n % LANE_IDS] * bool(n % LANE_IDS)
                words.append(np.zeros(1, np.uint64))
                lanes = decode_lanes(np.concatenate(words), np.concatenate(starts), max(used), table, width)
                found = lanes[np.arange(lanes.shape[1]) < np.array(used)[:, None]].astype("<u4")
                out, at = [], 0
                for r in rows:
                    first = at
                    for doc_id, n in zip(r["doc_ids"], r["doc_sizes"], strict=True):
                        out.append((r["part"], r["block"], doc_id, n, zlib.crc32(found[at : at + n].tobytes()), at - first))
                        at += n
                kinds = [pa.int32(), *[pa.int64()] * 5]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "doc_id", "n_tokens", "ids_crc32", "in_block"])

    return run


def bounds_of(keys: DataFrame, parts: int) -> list[int]:
    """The last doc_id of each of about ``parts`` equal parts but the last, ascending; 8
    bytes for each part on the driver and in a task."""

    def cuts(n: int):
        return F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)

    if parts < 2:
        return []
    first = sorted(set(keys.agg(cuts(min(parts, CUTS))).first()[0] or []))
    inner = -(-parts // CUTS)
    if inner < 2 or not first:
        return first

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("doc_id").drop_null()
            at = np.searchsorted(first, known.to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), known], names=["range", "doc_id"])

    found = keys.mapInArrow(ranges, "range int, doc_id long").groupBy("range").agg(cuts(inner).alias("cuts")).collect()
    return sorted({*first, *(c for r in found for c in r["cuts"])})


def write(docs: DataFrame, tokenizer_path: str, end_id: int, out: str, drops_space: bool = False) -> None:
    """Encodes every whole text of ``docs`` (doc_id, text) into files under ``out``."""
    spark = docs.sparkSession
    ship(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    staged = scratch_dir(spark, "ids")
    tokens = read.mapInArrow(_tokenize(tokenizer_path, drops_space, end_id), "doc_id long, n long, ids binary")
    tokens.write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.parquet(staged)

    # One row per id in use, at most the vocabulary.
    uses = tokens.select("n", "ids").mapInArrow(_count, "id long, uses long").groupBy("id").agg(F.sum("uses").alias("uses"))
    code = uses.orderBy("id").toPandas()
    ids, lengths = code["id"].to_numpy(np.int64), code_lengths(code["uses"].to_numpy(np.int64))
    rows = [(int(i), int(n)) for i, n in zip(ids, lengths, strict=True)]
    spark.createDataFrame(rows, "id long, bits int").coalesce(1).write.parquet(f"{out}/code")
    if not len(ids):
        spark.createDataFrame([], _BLOCKS).write.parquet(f"{out}/blocks")
        return

    bounds = bounds_of(tokens.select("doc_id"), int(1 + code["uses"].sum() // PART_IDS))
    coded = tokens.mapInArrow(_encode(ids, lengths, bounds), "part int, doc_id long, n long, checkpoints binary, payload binary")
    # One part to a task.
    ordered = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "n", "payload")
    ordered.mapInArrow(_blocks, _BLOCKS).write.parquet(f"{out}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents in the files under ``path``: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    code = spark.read.parquet(f"{path}/code").orderBy("id").toPandas()  # at most the vocabulary
    blocks = spark.read.parquet(f"{path}/blocks")
    if not len(code):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    ids, lengths = code["id"].to_numpy(np.int64), code["bits"].to_numpy(np.int64)
    decoded = blocks.mapInArrow(_decode(ids, lengths), _DECODED)
    before = lambda w: F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1))
    sizes = blocks.select("part", "block", "n_ids")
    # One row for each part meets in the first window.
    of_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", F.coalesce(before(Window.orderBy("part")), F.lit(0)).alias("part_start"))
    in_part = sizes.select("part", "block", F.coalesce(before(Window.partitionBy("part").orderBy("block")), F.lit(0)).alias("block_start"))
    at = in_part.join(of_part, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("base"))
    return decoded.join(at, ["part", "block"]).select("doc_id", (F.col("base") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32")
