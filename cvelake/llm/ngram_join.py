"""N-gram Jaccard join by prefix trees, and the groups of near duplicates it finds.

Documents are sets of five-word shingles; two link when 100 * |both| >= 80 * |either|.
Nothing is lost: every reduction below is exact.

1. Equal sets are one class. All shingles in a fixed range of the hash space are
   aggregated over the corpus; a class with more shingles of its own than 20 % of
   its size allows can link with none, and leaves. What stays is counted again
   with all of its shingles. Most documents go this way without leaving more than
   a few numbers.
2. Prefixes: two linked classes share a shingle among the first n - ceil(0.8 n) + 1
   of each, in any order common to all. The order is by the number of classes that
   hold a shingle, rarest first, so the prefix is filled with shingles of the class's
   own and of its near copies, and passages that many documents share stay out of
   it. Shingles of one class alone match nothing and are left out of the lists.
   Connected lists form candidate groups.
3. Within a group the sets, in one common order with the most frequent shingles
   first, are stored in a prefix tree. A set walks the tree, nodes share the overlap
   up to them, and a subtree is left as soon as the overlap so far and what remains
   of either side can't reach the bound. Sets that are linked leave the tree and walk
   it in turn, so a group of n near copies takes about n walks, not n * n checks.
4. A group beyond ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles is split into blocks, each a tree of its own. One
   set walks all blocks of its group; sets that are not yet in its component walk
   all blocks too, as probes, so a pair goes unchecked only if it is connected.

Defined results: null and empty texts have an empty set and link with nothing;
equal texts link; repeated rows each get a row; rows without doc_id link with
nothing and have no component id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cvelake.llm.common import fresh_column, ship
from cvelake.llm.components import components
from cvelake.llm.shingles import set_id, shingle_sets
from cvelake.llm.tokens import forget
from cvelake.session import stage

#: Two sets link at this many hundredths.
PERCENT = 80
#: Share of the hash space whose shingles are counted first.
RANGE = 0.35
#: So many open classes are sent to the tasks that read the texts; more are joined
#: by a shuffle.
MOST_SENT = 1_000_000
#: Sets, and shingles in them, of one tree.
BLOCK_SETS = 4096
BLOCK_SHINGLES = 4_000_000
#: Tokens of a tree's node that are compared between two looks at the bounds.
STEP = 64


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any set that it links to."""
    return -(-PERCENT * n // 100)


def slack(n) -> F.Column:
    """Shingles of its own that a linked set of ``n`` may have at most."""
    return F.col(n) - F.ceil(F.col(n) * PERCENT / F.lit(100))


# ---------------------------------------------------------------- passes over texts


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        sizes, ids = [], []
        for own in shingle_sets(batch.column("text")):
            sizes.append(len(own))
            ids.append(set_id(own) if len(own) else None)
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "class"])


def _ends(tokens: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its smallest and, if there are several, its largest owner: what
    of a batch matters to whether a token has one owner."""
    if not len(tokens):
        return tokens, owners
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    new = tokens[1:] != tokens[:-1]
    first, last = np.concatenate([[True], new]), np.concatenate([new, [True]])
    keep = first | (last & np.concatenate([[False], owners[1:] != owners[:-1]]))
    # A last row that equals the first one's owner says nothing new.
    start = np.maximum.accumulate(np.where(first, np.arange(len(tokens)), 0))
    keep &= first | (owners != owners[start])
    return tokens[keep], owners[keep]


def _in_range(share: float):
    most = np.uint64(int(min(1.0, share) * (2**64 - 2**12)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen: set[int] = set()  # copies in one task count once
        for batch in batches:
            tokens, owners = [], []
            for own in shingle_sets(batch.column("text")):
                if not len(own) or (key := set_id(own)) in seen:
                    continue
                seen.add(key)
                low = own[: np.searchsorted(own, most, side="right")]
                tokens.append(low)
                owners.append(np.full(len(low), key, np.int64))
            if tokens:
                found = _ends(np.concatenate(tokens).view(np.int64), np.concatenate(owners))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["token", "class"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of rows whose class is the one asked for."""
    for batch in batches:
        rows = []
        asked = zip(batch.column("class").to_pylist(), batch.column("copies").to_pylist(), shingle_sets(batch.column("text")), strict=True)
        for key, copies, own in asked:
            if len(own) and set_id(own) == key:
                rows.append((key, len(own), copies, own.astype("<u8").tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["class", "n", "copies", "tokens"])


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts = batch.column("class").to_numpy(), batch.column("n").to_numpy()
        for first in range(0, len(keys), 512):
            data = b"".join(batch.column("tokens").slice(first, 512).to_pylist())
            sizes = counts[first : first + 512]
            columns = [np.frombuffer(data, "<i8"), np.repeat(keys[first : first + 512], sizes), np.repeat(sizes, sizes).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "class", "n"])


# ---------------------------------------------------------------- the prefix tree


class PrefixTree:
    """Sets as paths of a compressed trie, in one order common to all of them."""

    def __init__(self, sets: list[np.ndarray]):
        everything = np.concatenate(sets)
        self.known, inverse, uses = np.unique(everything, return_inverse=True, return_counts=True)
        rank = np.empty(len(self.known), np.int64)
        rank[np.lexsort((self.known, -uses))] = np.arange(len(self.known))  # most frequent first
        self.rank = rank
        borders = np.cumsum([0, *map(len, sets)])
        self.paths = [np.sort(rank[inverse[a:b]]) for a, b in zip(borders[:-1], borders[1:], strict=True)]
        self.mark = np.zeros(len(self.known), bool)
        # node: [set whose path it lies on, from, to, children, sets that end here]
        self.nodes: list[list] = []
        self.parent: list[int] = []
        order = sorted(range(len(sets)), key=lambda i: self.paths[i].astype(">i8").tobytes())
        root = self._node(-1, order[0], 0, 0)
        self.end_of = [0] * len(sets)
        stack, before = [root], None
        for i in order:
            path = self.paths[i]
            common = 0
            if before is not None:
                short = min(len(before), len(path))
                differ = np.flatnonzero(before[:short] != path[:short])
                common = int(differ[0]) if len(differ) else short
            while self.nodes[stack[-1]][1] >= common and len(stack) > 1:
                stack.pop()
            top = stack[-1]
            if self.nodes[top][2] > common:  # the path leaves inside this node: cut it
                own, low, high, children, ends = self.nodes[top]
                rest = self._node(top, own, common, high)
                self.nodes[rest][3], self.nodes[rest][4] = children, ends
                for c in children:
                    self.parent[c] = rest
                for s in ends:
                    self.end_of[s] = rest
                self.nodes[top] = [own, low, common, [rest], []]
            if common < len(path):
                new = self._node(top, i, common, len(path))
                self.nodes[top][3].append(new)
                stack.append(new)
            self.nodes[stack[-1]][4].append(i)
            self.end_of[i] = stack[-1]
            before = path
        sizes = [len(p) for p in self.paths]
        self.alive = [0] * len(self.nodes)
        self.shortest, self.longest = [1 << 60] * len(self.nodes), [0] * len(self.nodes)
        self.ended: list[list[int]] = [list(n[4]) for n in self.nodes]
        for i, n in enumerate(sizes):
            node = self.end_of[i]
            while node >= 0:
                self.alive[node] += 1
                self.shortest[node] = min(self.shortest[node], n)
                self.longest[node] = max(self.longest[node], n)
                node = self.parent[node]

    def _node(self, parent: int, owner: int, low: int, high: int) -> int:
        self.nodes.append([owner, low, high, [], []])
        self.parent.append(parent)
        return len(self.nodes) - 1

    def remove(self, i: int) -> None:
        node = self.end_of[i]
        self.ended[node].remove(i)
        while node >= 0:
            self.alive[node] -= 1
            node = self.parent[node]

    def linked(self, probe: np.ndarray) -> list[int]:
        """The sets still in the tree that link with ``probe`` (a set of hashes)."""
        if not self.alive[0]:
            return []
        at = np.minimum(np.searchsorted(self.known, probe), len(self.known) - 1)
        own = np.sort(self.rank[at[self.known[at] == probe]])
        self.mark[own] = True
        n, found, stack = len(probe), [], [(0, 0)]
        while stack:
            node, overlap = stack.pop()
            owner, low, high, children, _ = self.nodes[node]
            shortest, longest = self.shortest[node], self.longest[node]
            if 100 * longest < PERCENT * n or 100 * n < PERCENT * shortest:
                continue
            bound = -(-PERCENT * (n + max(shortest, least_overlap(n))) // (100 + PERCENT))
            path = self.paths[owner]
            while low < high:
                step = path[low : min(high, low + STEP)]
                low += len(step)
                overlap += int(np.count_nonzero(self.mark[step]))
                rest = min(longest - low, len(own) - int(np.searchsorted(own, step[-1], side="right")))
                if overlap + rest < bound:
                    break
            else:
                for i in self.ended[node]:
                    if 100 * overlap >= PERCENT * (n + len(self.paths[i]) - overlap):
                        found.append(i)
                stack += [(c, overlap) for c in children if self.alive[c]]
        self.mark[own] = False
        return found


def spanning_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect just what the links of all pairs connect."""
    if len(sets) < 2:
        return []
    tree, links, left = PrefixTree(sets), [], set(range(len(sets)))
    while left:
        queue = [left.pop()]
        tree.remove(queue[0])
        while queue:
            i = queue.pop()
            for j in tree.linked(sets[i]):
                tree.remove(j)
                left.discard(j)
                links.append((i, j))
                queue.append(j)
    return links


_LINKS = "a long, b long"


def _unpacked(group: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    unique = dict(zip(group.column("class").to_pylist(), group.column("tokens").to_pylist(), strict=True))
    return list(unique), [np.frombuffer(x, "<u8") for x in unique.values()]


def _as_links(found: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*found, strict=True) if found else ([], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _join_group(group: pa.Table) -> pa.Table:
    keys, sets = _unpacked(group)
    return _as_links([(keys[i], keys[j]) for i, j in spanning_links(sets)])


def _join_probes(group: pa.Table) -> pa.Table:
    """Links of the group's probes with the sets of one block."""
    is_probe = group.column("probe")
    block, probes = group.filter(pc.invert(is_probe)), group.filter(is_probe)
    if not len(block) or not len(probes):
        return _as_links([])
    keys, sets = _unpacked(block)
    tree = PrefixTree(sets)
    found = [(key, keys[j]) for key, own in zip(*_unpacked(probes), strict=True) for j in tree.linked(own) if keys[j] != key]
    return _as_links(found)


def _block_links(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links within groups that are too large for one tree."""
    blocks = sizes.select("label", "blocks")
    dealt = members.join(blocks, "label").withColumn("block", F.expr("cast(pmod(xxhash64(class), blocks) as int)"))
    dealt = stage(dealt, "blocks")
    inside = stage(dealt.groupBy("label", "block").applyInArrow(_join_group, _LINKS), "links")
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def with_probes(probes: DataFrame) -> DataFrame:
        asked = probes.withColumn("block", every_block).withColumn("probe", F.lit(True)).drop("blocks")
        both = dealt.withColumn("probe", F.lit(False)).drop("blocks").unionByName(asked.select("label", "class", "n", "tokens", "block", "probe"))
        return stage(both.groupBy("label", "block").applyInArrow(_join_probes, _LINKS), "links")

    # One set of each group, from its largest component so far, meets every block.
    own = components(inside).select(F.col("node").alias("class"), F.col("label").alias("part"))
    parts = dealt.select("label", "class").join(own, "class").groupBy("label", "part").agg(F.count("*").alias("size"), F.min("class").alias("class"))
    leaders = parts.groupBy("label").agg(F.max_by("class", F.struct("size", "class")).alias("class"))
    first = with_probes(dealt.join(leaders, ["label", "class"], "left_semi"))
    # Sets that aren't connected to that one yet meet every block, too.
    so_far = stage(inside.union(first), "links")
    now = components(so_far).select(F.col("node").alias("class"), F.col("label").alias("part"))
    led = leaders.join(now, "class").select("label", F.col("part").alias("led"))
    state = dealt.join(now, "class", "left").join(led, "label", "left")
    rest = state.filter(~F.coalesce(F.col("part") == F.col("led"), F.lit(False))).select(dealt.columns)
    return so_far.union(with_probes(rest))


# ---------------------------------------------------------------- the join


def classes_of(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), class (null for an empty set) of every row."""
    ship(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return read.mapInArrow(_classes, "doc_id long, n long, class long")


def _sets_of(read: DataFrame, asked: DataFrame) -> DataFrame:
    """class, n, tokens of every class in ``asked`` (doc_id, class, copies), once each."""
    if asked.count() <= MOST_SENT:
        asked = F.broadcast(asked)
    found = read.join(asked, "doc_id").select("class", "copies", "text").mapInArrow(_sets, "class long, n long, copies long, tokens binary")
    found = stage(found, "sets")
    # Only rows that share both id and text can give a class twice.
    once, several = found.filter("copies = 1"), found.filter("copies > 1").dropDuplicates(["class"])
    return once.unionByName(several).drop("copies")


def links(docs: DataFrame, classes: DataFrame, block_sets: int = BLOCK_SETS, share: float = RANGE) -> DataFrame:
    """Links between classes (a, b) that connect all linked classes of ``docs``."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    ranged = read.select("text").mapInArrow(_in_range(share), "token long, class long")
    # Batches are combined before the shuffle (_ends), so a partial aggregate would add nothing.
    ends = ranged.repartition("token").groupBy("token").agg(F.min("class").alias("class"), F.max("class").alias("last"))
    own = stage(ends.filter("class = last").groupBy("class").agg(F.count("*").alias("own")), "own_tokens")

    rows = classes.filter("class is not null and doc_id is not null").groupBy("class", "n", "doc_id").agg(F.count("*").alias("copies"))
    known = rows.groupBy("class", "n").agg(F.min(F.struct("doc_id", "copies")).alias("row"))
    open_classes = known.join(own, "class", "left").filter(F.coalesce("own", F.lit(0)) <= slack("n"))
    asked = stage(open_classes.select("row.doc_id", "class", "row.copies"), "open_classes")
    sets = _sets_of(read, asked)

    tokens = sets.mapInArrow(_all_tokens, "token long, class long, n int")
    uses = tokens.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("uses"))
    shared = tokens.join(stage(uses.filter("low < high").select("token", "uses"), "shared_tokens"), "token")
    # A class's own shingles come first in its prefix; what is left of it goes to
    # the rarest shared ones, and a class that has none left is out.
    of_class = Window.partitionBy("class")
    placed = shared.withColumn("shared", F.count("*").over(of_class)).withColumn("place", F.row_number().over(of_class.orderBy("uses", "token")))
    least = F.ceil(F.col("n") * PERCENT / F.lit(100))
    entries = stage(placed.filter(F.col("place") <= F.col("shared") - least + 1).select("token", "class"), "prefixes")

    heads = entries.groupBy("token").agg(F.min("class").alias("head"), F.max("class").alias("last")).filter("head < last")
    heads = stage(heads.select("token", "head"), "heads")
    candidates = entries.join(heads, "token").filter("class <> head").select(F.col("class").alias("a"), F.col("head").alias("b")).distinct()
    groups = components(candidates).select(F.col("node").alias("class"), "label")
    grouped = sets.join(groups, "class").select("label", "class", "n", "tokens")
    grouped = stage(grouped, "members")
    needed = F.ceil(F.greatest(F.count("*") / F.lit(block_sets), F.sum("n") / F.lit(BLOCK_SHINGLES)))
    sizes = stage(grouped.groupBy("label").agg(needed.cast("int").alias("blocks")), "group_sizes")
    large_sizes = sizes.filter("blocks > 1")
    if large_sizes.isEmpty():
        return stage(grouped.groupBy("label").applyInArrow(_join_group, _LINKS), "links")
    small = grouped.join(sizes.filter("blocks = 1").select("label"), "label", "left_semi")
    large = grouped.join(large_sizes.select("label"), "label", "left_semi")
    found = stage(small.groupBy("label").applyInArrow(_join_group, _LINKS), "links")
    return found.union(_block_links(large, large_sizes))


def groups(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, class, component_id of every row of ``docs`` (doc_id, text)."""
    classes = stage(classes_of(docs), "classes")
    joined = components(links(docs, classes, **options)).select(F.col("node").alias("class"), "label")
    known = classes.filter("class is not null and doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    known = known.join(joined, "class", "left").withColumn("label", F.coalesce("label", "class"))
    known = stage(known, "class_groups")
    least = stage(known.groupBy("label").agg(F.min("least").alias("component_id")), "group_least")
    of_class = stage(known.join(least, "label").select("class", "component_id"), "class_components")
    linked = classes.filter("class is not null and doc_id is not null").join(of_class, "class")
    alone = classes.filter("class is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "class", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id
    (of repeated rows, any). Rows without doc_id or without words stay."""
    found = stage(groups(docs, **options), "groups")
    first = found.filter("class is not null and doc_id is not null").groupBy("component_id").agg(F.min(F.struct("doc_id", "class")).alias("first"))
    first = stage(first.select("first.doc_id", "first.class"), "first_of_group")
    name = fresh_column(docs, "class")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            ids = pa.array([set_id(s) if len(s) else None for s in shingle_sets(texts)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, name])

    marked = docs.mapInArrow(with_class, schema)
    alone = marked.filter(F.col(name).isNull() | F.col("doc_id").isNull())
    kept = marked.join(first.withColumnRenamed("class", name), ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return kept.unionByName(alone).drop(name)
