"""Merkle manifest of documents, with proofs climbed by a recursive query.

A document's leaf is the hash of its fields. The leaves of each source, in the order of
doc_id, and above them the sources' subroots, in the order of source, are hashed in runs
of three until one is left. ``build`` stores the levels as rows that link a node to its
ancestor: a row stands for a node of each ``HOP``-th level and holds, for the levels
between, the digests of its run's members to the left and to the right. ``climb`` is a
recursive query: beginning with the leaves it joins the rows on their links, appends
the siblings met and folds a leaf's digest with them, until no link is left.

Numbering: documents are dealt by range of (source, doc_id, leaf) and numbered by a sum
over the parts, so a source of any size is spread over many tasks. Runs are grouped by
whole blocks of 3 ** HOP nodes, which bounds every group. A node row that stands above
more than one ``SPREAD``-th of the leaves would gather that share of them in one task
of the join; there are fewer than ``SPREAD`` such nodes on a level, so these are
broadcast, and the join below them is dealt by key. Siblings are appended as rows, one a
hop, and joined into a proof at the end, so that no proof is carried along.

Digests are stored as bytes and hashed as lower-case hex text. Defined results: null
fields hash as ``-``; null sources and ids come first; equal ids are ordered by leaf
(rows that are equal in all have equal leaves, so their places are interchangeable); a
lone leaf is its subroot, and a lone subroot the root; a leaf without siblings has the
hash of the empty text as its proof; an empty table gives no rows. Columns besides
``FIELDS`` are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvelake.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 3
HOP = 3
SPREAD = 20_000
#: The tree above the sources; sources have numbers from 0.
TOP = -1
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

#: A hop appends the siblings of the levels passed and folds the digest level by level.
_CLIMB = """
WITH RECURSIVE climb (leaf, tree, level, pos, siblings, folded, more) MAX RECURSION LEVEL 1000 AS (
    SELECT leaf, tree, level, pos, X'' AS siblings, folded, true AS more FROM {start}
    UNION ALL
    SELECT /*+ HINT */ c.leaf, n.up_tree, n.up_level, n.up_pos, n.siblings,
           aggregate(n.runs, c.folded, (digest, run) -> unhex(sha2(
               concat(lower(hex(run.before)), lower(hex(digest)), lower(hex(run.after))), 256))),
           n.more
    FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.level = n.level AND c.pos = n.pos
)
SELECT * FROM climb
"""


def digest_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_of(text: Column) -> Column:
    """Digest of a document's fields, with ``text`` as its text."""

    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    fields = [field(text if name == "text" else F.col(name)) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df``, written, with its rows' numbers from 0 in the given order as ``name``,
    and the task that wrote a row as ``part``."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows, "merkle_order").withColumn("part", F.shiftright("at", 33))
    # One row for each task of the write, whatever the data.
    sizes = rows.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("n")).collect()
    shifts, total = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        shifts.append((r["part"], total - r["first"]))
        total += r["n"]
    table = df.sparkSession.createDataFrame(shifts, "part long, shift long")
    return rows.join(F.broadcast(table), "part").withColumn(name, F.col("at") + F.col("shift")).drop("at", "shift")


def _block_levels(nodes: DataFrame, hop: int) -> DataFrame:
    """Blocks of RUN ** hop nodes of a tree: ``own`` nodes, and the hex digests d0, d1
    and so on of the block's part of each level."""
    block = nodes.filter("n > 1").groupBy("tree", F.expr(f"pos div {RUN**hop}").alias("block"), "n")
    own = F.array_sort(F.collect_list(F.struct("pos", "digest", "span")))
    row = block.agg(own.alias("own"), F.sum("span").alias("up_span"))
    row = row.withColumn("up_n", F.expr(f"(n + {RUN**hop - 1}) div {RUN**hop}"))
    row = row.withColumn("d0", F.transform("own", lambda x: digest_text(x["digest"])))
    for k in range(hop):
        # A tree ends on the level where it has a single node.
        row = row.withColumn(f"d{k + 1}", F.when(F.col("n") > RUN**k, _hashed_runs(F.col(f"d{k}"))).otherwise(F.col(f"d{k}")))
    return row


def _hashed_runs(level: Column) -> Column:
    last = F.floor((F.size(level) - 1) / RUN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(level, i * RUN + 1, RUN), ""), 256))


def _runs(j: Column, hop: int) -> Column:
    """What stands before and after a block's j-th node, and then its ancestors, in
    their runs."""
    found = []
    for k in range(hop):
        place = F.floor(j / RUN**k).cast("int")
        before, after = [
            F.unhex(F.array_join(F.slice(F.col(f"d{k}"), first + 1, length), ""))
            for first, length in ((place - place % RUN, place % RUN), (place + 1, F.lit(RUN - 1) - place % RUN))
        ]
        found.append(F.when(F.col("n") > RUN**k, F.struct(before.alias("before"), after.alias("after"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def build(nodes: DataFrame, name: str, hop: int = HOP) -> tuple[list[DataFrame], DataFrame, int]:
    """Node rows by level, the (tree, digest, span) on top of each tree, and the number
    of levels. ``nodes``: (tree, pos, digest, n: nodes of the tree, span: leaves beneath)."""
    rows, tops, level = [], [], 0
    while True:
        tops.append(nodes.filter("n = 1").select("tree", "digest", "span"))
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            break
        blocks = _block_levels(nodes, hop)
        placed = blocks.select("*", F.posexplode("own").alias("j", "node")).withColumn("runs", _runs(F.col("j"), hop))
        # The top of a source's tree is a leaf of the tree above the sources.
        leaves_tree = (F.col("up_n") == 1) & (F.col("tree") != TOP)
        linked = placed.select(
            "tree",
            F.lit(level).alias("level"),
            F.col("node.pos").alias("pos"),
            F.when(leaves_tree, TOP).otherwise(F.col("tree")).cast("long").alias("up_tree"),
            F.when(leaves_tree, 0).otherwise(level + 1).alias("up_level"),
            F.when(leaves_tree, F.col("tree")).otherwise(F.col("block")).alias("up_pos"),
            "runs",
            F.aggregate("runs", F.lit(b""), lambda acc, r: F.concat(acc, r["before"], r["after"])).alias("siblings"),
            F.col("node.span").alias("span"),
            "up_span",
        )
        rows.append(stage(linked, f"merkle_{name}_{level}"))
        up = blocks.select("tree", F.col("block").alias("pos"), F.unhex(F.get(f"d{hop}", F.lit(0))).alias("digest"), F.col("up_n").alias("n"), F.col("up_span").alias("span"))
        nodes = stage(up, f"merkle_{name}_above_{level}")
        level += 1
    found = tops[0]
    for t in tops[1:]:
        found = found.unionAll(t)
    return rows, found, level


def climb(start: DataFrame, nodes: DataFrame, hint: str = "") -> DataFrame:
    """Every stop of every leaf's way up: (leaf, tree, level, pos, siblings, folded,
    more: whether ``nodes`` leads on). ``start``: (leaf, tree, level, pos, folded)."""
    spark = start.sparkSession
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return stage(spark.sql(_CLIMB.replace("/*+ HINT */", hint), start=start, nodes=nodes), "merkle_climb")
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def verify(docs: DataFrame, tampered: Column, hop: int = HOP, spread: int = SPREAD) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every
    document. ``tampered`` is the text that is checked against the manifest of ``docs``."""
    spark = docs.sparkSession
    hashed = docs.select("doc_id", "source", leaf_of(F.col("text")).alias("digest"), leaf_of(tampered).alias("folded"), F.monotonically_increasing_id().alias("row"))
    ordered = numbered(stage(hashed, "merkle_leaves"), ["source", "doc_id", "digest", "row"], "leaf")
    # A source has one row for each part it touches, and joins go by part and source.
    pairs = stage(ordered.groupBy("part", "source").agg(F.min("leaf").alias("first"), F.count("*").alias("n")), "merkle_pairs")
    sources = numbered(pairs.groupBy("source").agg(F.min("first").alias("first"), F.sum("n").alias("n")), ["source"], "tree")
    known = sources.select(F.col("source").alias("of"), "tree", "first", "n")
    located = stage(pairs.select("part", "source").join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "merkle_located")
    own = located.select(F.col("part").alias("in_part"), F.col("source").alias("of"), "tree", "first", "n")
    leaves = ordered.join(own, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("of")))
    leaves = stage(leaves.select("leaf", "doc_id", "part", "tree", (F.col("leaf") - F.col("first")).alias("pos"), "n", "digest", "folded"), "merkle_placed")
    total, trees = leaves.count(), sources.count()
    if not total:
        return leaves.select("doc_id", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(True).alias("verified"))

    rows, subroots, _ = build(leaves.select("tree", "pos", "digest", "n", F.lit(1).cast("long").alias("span")), "source", hop)
    subroots = stage(subroots, "merkle_subroots")
    above = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(trees).cast("long").alias("n"), "span")
    top_rows, root, height = build(above, "top", hop)
    root = root.select(digest_text(F.col("digest"))).first()[0]

    least = total // spread
    nodes = (rows + top_rows)[0] if rows + top_rows else None
    for more in (rows + top_rows)[1:]:
        nodes = nodes.unionAll(more)
    lone = F.col("n") == 1
    start = leaves.select(
        "leaf",
        F.when(lone, TOP).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.lit(0).alias("level"),
        F.when(lone, F.col("tree")).otherwise(F.col("pos")).alias("pos"),
        "folded",
    )
    stops = []
    if nodes is not None:
        columns = ["tree", "level", "pos", "up_tree", "up_level", "up_pos", "runs", "siblings"]
        nodes = nodes.withColumn("more", F.col("up_span") <= least)
        if least:
            stops.append(climb(start, nodes.filter(F.col("span") <= least).select(*columns, "more")))
            start = stops[0].filter("NOT more").select("leaf", "tree", "level", "pos", "folded")
        # Fewer than ``spread`` nodes on a level.
        high = nodes.filter(F.col("span") > least).select(*columns, F.lit(True).alias("more"))
        stops.append(climb(start, high, "/*+ BROADCAST(n) */"))
    else:
        stops.append(start.select("*", F.lit(b"").alias("siblings"), F.lit(True).alias("more")))
    at_root = (F.col("tree") == TOP) & (F.col("level") == height)
    each = [s.select("leaf", (F.col("tree") == TOP).alias("top"), "level", "siblings", F.when(at_root, F.col("folded")).alias("folded")) for s in stops]
    every = each[0] if len(each) == 1 else each[0].unionAll(each[1])
    met = F.array_sort(F.collect_list(F.struct("top", "level", "siblings")))
    proofs = every.groupBy("leaf").agg(met.alias("met"), F.max("folded").alias("end"))
    proof = F.sha2(F.array_join(F.transform("met", lambda m: digest_text(m["siblings"])), ""), 256)
    proofs = proofs.select("leaf", proof.alias("proof_sha256"), digest_text(F.col("end")).alias("folded_root"))
    tops = located.select("part", "tree").join(subroots.select("tree", digest_text(F.col("digest")).alias("subroot")), "tree")
    found = leaves.select("leaf", "part", "tree", "doc_id", "digest").join(proofs, "leaf").join(tops, ["part", "tree"])
    return found.select("doc_id", digest_text(F.col("digest")).alias("leaf"), "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
