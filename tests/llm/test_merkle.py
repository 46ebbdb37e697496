"""The Merkle manifest against a plain version, whole and in its edge cases."""

import hashlib
import zlib

import pytest
from helpers_llm import DOCS, SF, doc_rows
from pyspark.sql import functions as F

from cvelake.llm import merkle, queries


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*[field(row[c]) for c in merkle.FIELDS[:4]], field(text))


def tree(leaves):
    """(root, for each leaf the runs on its way as (before, after))."""
    ways, members, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, beneath = [], []
        for first in range(0, len(nodes), 3):
            run = nodes[first : first + 3]
            for j in range(len(run)):
                for m in members[first + j]:
                    ways[m].append((run[:j], run[j + 1 :]))
            above.append(digest(*run))
            beneath.append(sum(members[first : first + 3], []))
        nodes, members = above, beneath
    return nodes[0], ways


def tampered(row):
    key = row["doc_id"]
    if key is None or row["text"] is None or zlib.crc32(str(key).encode()) % 2:
        return row["text"]
    return row["text"].replace("\n", "")


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    kept = []
    for s in sources:
        own = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        kept.append((own, *tree([leaf(r, r["text"]) for r in own])))
    root, above = tree([top for _, top, _ in kept])
    out = []
    for (own, top, ways), way_up in zip(kept, above, strict=True):
        for r, way in zip(own, ways, strict=True):
            fold, proof = leaf(r, tampered(r)), ""
            for before, after in way + way_up:
                proof += "".join(before + after)
                fold = digest(*before, fold, *after)
            out.append((r["doc_id"], leaf(r, r["text"]), top, root, digest(proof), fold, fold == root))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def verify(docs, **options):
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(F.coalesce(key % 2 == 0, F.lit(False)), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(docs, text, **options)


def test_query_equals_plain_version(spark):
    found = queries.op11_merkle_climb(spark, SF).collect()
    assert in_order(found) == in_order(plain(doc_rows(spark)))
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("hop,spread", [(1, 4), (3, 30)])
def test_hops_and_the_share_of_broadcast_nodes_change_nothing(spark, hop, spread):
    rows = [(i, f"a\nb{i}", "en", ["hot", "hot", f"s{i % 17}"][i % 3], i) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    found = verify(docs, hop=hop, spread=spread).collect()
    assert in_order(found) == in_order(plain([r.asDict() for r in docs.collect()]))


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [
        (1, "x\ny", None, "s", 3),
        (1, "x\ny", None, "s", 3),
        (1, None, "en", "s", None),
        (None, "\n", "en", "s", 1),
        (None, None, None, None, None),
        (2, "", "de", None, 0),
        (3, "ä\n" * 50_000, "de", "ß", 100_000),
        (4, "only", "en", "Z", 4),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    wide = docs.withColumns({c: F.lit("other") for c in ("leaf", "root", "tree", "pos", "part", "row", "at", "n", "digest")})
    assert in_order(verify(wide).collect()) == in_order(plain([r.asDict() for r in docs.collect()]))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_a_single_source(spark, n):
    docs = spark.createDataFrame([(i, f"{i}\n", "en", "s", 2) for i in range(n)], DOCS)
    found = verify(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert in_order(found.collect()) == in_order(plain([r.asDict() for r in docs.collect()]) if n else [])


def test_trees_of_many_sizes(spark):
    sizes = [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 81, 82]
    rows = [(1000 * k + i, f"{i}\n", "en", f"s{k}", 2) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    assert in_order(verify(docs).collect()) == in_order(plain([r.asDict() for r in docs.collect()]))


def test_equal_rows_of_one_source_are_spread_over_tasks(spark):
    docs = spark.createDataFrame([(7, "same", "en", "hot", 4)] * 5000, DOCS).repartition(8)
    found = merkle.numbered(docs.withColumn("row", F.monotonically_increasing_id()), ["source", "doc_id", "row"], "number")
    assert sorted(r["number"] for r in found.collect()) == list(range(5000))
