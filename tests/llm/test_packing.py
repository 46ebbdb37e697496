import public_tokenizers
from pyspark.sql import functions as F

from cvelake.llm import packing
from cvelake.llm.queries import QUERIES
from helpers_llm import SF, crc, doc_rows, reference_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity):
    """Pieces are the documents' ids, and sequences are gapless and not too long."""
    want = []
    for doc_id, text in docs:
        ids = [*reference_ids("word_bpe_49k.json", text), 1]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((doc_id, n, start, len(part), crc(part)))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    key = lambda x: (x[0] is not None, x)
    assert sorted(got, key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_packs_whole_documents_tightly(spark):
    rows = [r.asDict() for r in QUERIES["op9_best_fit_packing"](spark, SF).collect()]
    n = check(rows, [(d["doc_id"], d["text"]) for d in doc_rows(spark)], 4096)
    assert n <= 1.06 * sum(r["length"] for r in rows) / 4096 + 1


def test_edges_and_left_over_bins(spark):
    docs = [(1, None), (2, ""), (None, "a b c"), (3, "dup dup"), (3, "dup dup"), (4, "long " * 100), (5, "one two three four five six seven")]
    docs += [(10 + i, "w " * (i % 9)) for i in range(60)]
    df = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, sequence_id int, piece string").repartition(7)
    rows = [r.asDict() for r in packing.pack(df, PATH, 1, capacity=16, open_bins=2, tasks_per_repack=2).collect()]
    check(rows, docs, 16)
    assert packing.pack(df.filter(F.lit(False)), PATH, 1).count() == 0


def test_best_fit_and_fullest_closes_first():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6)[:2] == (0, 10)
    assert bins.place(7)[:2] == (1, 10)
    assert bins.place(3)[:2] == (1, 3)  # the tighter of the two
    assert bins.place(5)[0] == 2
    assert bins.place(8) == (3, 10, [3])  # a third open bin: the fullest closes
    assert bins.remaining() == {0, 2}
