import heapq

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from cvelake.llm import huffman
from cvelake.llm.queries import QUERIES
from cvelake.session import scratch_dir
from helpers_llm import SF, crc, doc_rows, reference_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs):
    key = lambda d: (d[0] is not None, d[0] or 0, len(d[1]))
    coded = sorted(((i, [*reference_ids("byte_bpe_50k.json", t), 0]) for i, t in docs), key=key)
    out, at = [], 0
    for i, ids in coded:
        out.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def as_rows(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=lambda r: r[1])


def test_query_reads_back_what_the_library_encodes(spark):
    assert as_rows(QUERIES["op7_huffman_token_ids"](spark, SF)) == expected([(d["doc_id"], d["text"]) for d in doc_rows(spark)])


def test_parts_and_edges(spark, monkeypatch):
    monkeypatch.setattr(huffman, "PART_IDS", 40)
    docs = [(None, "no id"), (7, None), (5, ""), (5, "twice"), (9, "x " * 700)] + [(100 - i, f"text {i} " * (i % 5)) for i in range(50)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, part int").repartition(5)
    out = scratch_dir(spark, "test-huffman")
    huffman.write(df, PATH, 0, out)
    assert as_rows(huffman.read(spark, out)) == expected(docs)
    empty = scratch_dir(spark, "test-huffman")
    huffman.write(df.filter(F.lit(False)), PATH, 0, empty)
    assert huffman.read(spark, empty).count() == 0


def test_parts_beyond_one_round_of_percentiles(spark, monkeypatch):
    monkeypatch.setattr(huffman, "CUTS", 4)
    keys = spark.createDataFrame([(i * i,) for i in range(400)] + [(None,)] * 50, "doc_id long").repartition(3)
    for parts in (1, 3, 4, 5, 20):
        bounds = huffman.bounds_of(keys, parts)
        assert bounds == sorted(set(bounds)) and parts - 1 <= len(bounds) + 1 <= parts + 4
        sizes = np.bincount(np.searchsorted(bounds, [i * i for i in range(400)], side="left"), minlength=len(bounds) + 1)
        assert sizes.max() <= 2 * 400 / parts + 2
    monkeypatch.setattr(huffman, "PART_IDS", 40)
    docs = [(None, "no id"), (7, None)] + [(100 - i, f"text {i} " * (i % 5)) for i in range(80)]
    out = scratch_dir(spark, "test-huffman")
    huffman.write(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), PATH, 0, out)
    assert as_rows(huffman.read(spark, out)) == expected(docs)
    per_task = spark.read.parquet(f"{out}/blocks").select("part", F.input_file_name().alias("f")).groupBy("f").agg(F.count_distinct("part").alias("n"))
    assert {r["n"] for r in per_task.collect()} == {1}  # one part to a task


def huffman_cost(weights):
    heap = list(weights)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


def test_code_lengths():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 300):
        weights = rng.integers(1, 1000, n)
        lengths = huffman.code_lengths(weights, 16)
        assert (2.0 ** -lengths).sum() <= 1
        if n > 1:
            assert (weights * lengths).sum() == huffman_cost(weights.tolist())
    steep = np.array([2**i for i in range(30)])
    lengths = huffman.code_lengths(steep, 8)
    assert lengths.max() == 8 and (2.0 ** -lengths).sum() <= 1
    assert len(huffman.code_lengths(np.zeros(0, np.int64))) == 0


def test_bits_round_trip():
    rng = np.random.default_rng(2)
    ids = np.array([3, 5, 9, 11, 40])
    lengths = huffman.code_lengths(np.array([100, 50, 20, 2, 1]), 16)
    codes = huffman.canonical_codes(lengths)
    message = rng.integers(0, 5, 1000)
    wide = lengths[message]
    offsets = np.cumsum(wide) - wide
    words = huffman.pack_bits(codes[message], wide, offsets, int(wide.sum()))
    table, width = huffman.decode_table(ids, lengths)
    lanes = huffman.decode_lanes(np.concatenate([words, np.zeros(2, np.uint64)]), offsets[::100], 100, table, width)
    assert lanes.ravel().tolist() == ids[message].tolist()
