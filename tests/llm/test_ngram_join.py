import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cvelake.llm import ngram_join as J
from cvelake.llm.components import components
from cvelake.llm.queries import QUERIES
from cvelake.llm.shingles import shingle_sets
from helpers_llm import SF, doc_rows, link_groups, shingles


def test_shingles_match_a_plain_version():
    rng = random.Random(2)
    words = ["ab", "CD", "ef", "\t", "\n", "K", "É", "x1", "\x1c", " ", "日本"]
    texts = [None, "", " \n", *(" ".join(rng.choices(words, k=rng.choice([1, 3, 5, 8, 40]))) for _ in range(200)), "w " * 900000]
    plain, hashed = [shingles(t) for t in texts], list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in plain] == [len(s) for s in hashed]
    assert all(len(plain[i] & plain[j]) == len(np.intersect1d(hashed[i], hashed[j])) for i in range(0, 200, 7) for j in range(200))


def families(rng, n_families, copies, base=40):
    """Texts in families of near copies, with shared passages and chains."""
    word = lambda: "w%d" % rng.randrange(5000)
    passage = " ".join(word() for _ in range(30))
    rows = []
    for _ in range(n_families):
        words = [word() for _ in range(rng.randint(5, base * 3))]
        for _ in range(rng.randint(1, copies)):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own) + (" " + passage if rng.random() < 0.3 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block_sets", [J.BLOCK_SETS, 3])
def test_groups_match_all_pairs(spark, block_sets):
    rows = families(random.Random(block_sets), 14, 9)
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE two"), (1004, "one"), (1005, rows[0][1]), (2000 - 1, rows[1][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("x")).withColumn("n", F.lit(0)).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.groups(df, block_sets=block_sets).collect()}
    want = link_groups(rows)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_large_group_of_near_copies_in_blocks(spark):
    rng = random.Random(8)
    base = ["b%d" % i for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(len(own))] = f"e{i}"
        rows.append((i, " ".join(own)))
    far = list(base)
    for at in (10, 50):
        far[at] = f"f{at}"  # links with some members only
    rows += [(60, " ".join(far)), (61, " ".join(far[:-3])), (62, " ".join(reversed(base)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in J.groups(df, block_sets=7).collect()}
    assert got == link_groups(rows)


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(3, text), (3, text), (2, text), (None, text), (9, "x y z")], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in J.groups(df).collect())
    assert got == [(False, 2, 4, 2), (False, 3, 4, 2), (False, 3, 4, 2), (False, 9, 1, 9), (True, 0, 4, None)]
    assert J.groups(df.filter("false")).count() == 0
    kept = J.keep_one(df.withColumn("class", F.lit("mine")))
    assert kept.columns == ["doc_id", "text", "class"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 2), (False, 9), (True, 0)]


def test_query_on_whole_documents(spark):
    rows = [(d["doc_id"], d["text"]) for d in doc_rows(spark)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_prefix_tree_join"](spark, SF).collect()}
    want = link_groups(rows)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_tree_finds_just_the_links():
    rng = np.random.default_rng(6)
    for trial in range(60):
        base = [rng.integers(0, 2**62, rng.choice([1, 3, 10, 40, 200])).tolist() for _ in range(4)]
        sets = []
        for _ in range(rng.integers(1, 25)):
            s = set(base[rng.integers(4)])
            for _ in range(rng.integers(0, 1 + len(s) // 6 + 1)):
                if rng.random() < 0.5 and len(s) > 1:
                    s.pop()
                else:
                    s.add(int(rng.integers(0, 2**62)))
            sets.append(np.array(sorted(s), np.uint64))
        tree, plain = J.PrefixTree(sets), [set(x.tolist()) for x in sets]
        for i, s in enumerate(sets):
            assert sorted(tree.linked(s)) == [j for j, t in enumerate(plain) if 100 * len(plain[i] & t) >= 80 * len(plain[i] | t)]


def test_ends_keep_what_tells_owners_apart():
    tokens, owners = J._ends(np.array([5, 3, 5, 5, 9, 9, 3]), np.array([2, 7, 4, 1, 6, 6, 7]))
    assert sorted(zip(tokens.tolist(), owners.tolist())) == [(3, 7), (5, 1), (5, 4), (9, 6)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (105, 105), (200, 199)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 199: 199, 200: 199}
    assert components(df.filter("false")).count() == 0
