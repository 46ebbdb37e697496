"""DuckDB SQL for the queries of this subpackage whose results SQL can state."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# All pairs that share a shingle, and all documents reachable over links.
NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS met
  FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * met >= 80 * (an + bn - met)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, min(r.b)) AS component_id
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Levels by recursive grouping; ways up by recursive replacement within the runs.
MERKLE = f"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8))) AS key
  FROM documents, crc),
changed AS (SELECT *, CASE WHEN key % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM docs),
leaves AS (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("other")} AS start FROM changed),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM leaves)),
placed AS (
  SELECT l.doc_id, l.leaf, l.start, s.tree, row_number() OVER (PARTITION BY s.tree ORDER BY l.doc_id NULLS FIRST, l.leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY s.tree) AS n
  FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source),
levels AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM levels WHERE n > 1 GROUP BY tree, level, pos // 3, n),
tops AS (SELECT tree, level, h FROM levels WHERE n = 1),
above AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM tops) AS n FROM tops
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY level, pos // 3, n),
runs AS (
  SELECT tree, level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM levels WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT -1, level, pos // 3, list(h ORDER BY pos) FROM above WHERE n > 1 GROUP BY ALL),
ways AS (
  SELECT row_number() OVER () AS r, doc_id, tree AS home, leaf,
    CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN tree ELSE pos END AS pos, start AS fold, '' AS proof FROM placed
  UNION ALL
  SELECT w.r, w.doc_id, w.home, w.leaf,
    CASE WHEN w.tree >= 0 AND t.level = w.level + 1 THEN -1 ELSE w.tree END,
    CASE WHEN w.tree >= 0 AND t.level = w.level + 1 THEN 0 ELSE w.level + 1 END,
    CASE WHEN w.tree >= 0 AND t.level = w.level + 1 THEN w.tree ELSE w.pos // 3 END,
    sha256(array_to_string(list_transform(u.hs, lambda x, i: CASE WHEN i = w.pos % 3 + 1 THEN w.fold ELSE x END), '')),
    w.proof || array_to_string(list_transform(u.hs, lambda x, i: CASE WHEN i = w.pos % 3 + 1 THEN '' ELSE x END), '')
  FROM ways w JOIN runs u ON u.tree = w.tree AND u.level = w.level AND u.run = w.pos // 3 LEFT JOIN tops t ON t.tree = w.tree),
root AS (SELECT h, level FROM above WHERE n = 1)
SELECT w.doc_id, w.leaf, t.h AS subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.fold AS folded_root, w.fold = root.h AS verified
FROM ways w JOIN root ON w.tree = -1 AND w.level = root.level JOIN tops t ON t.tree = w.home
"""


def _centroids(rounds: int = 10) -> str:
    """Every round as a step of its own, all distances."""
    steps = ["""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), p) - 1 AS c, p
  FROM (SELECT * FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id), p LIMIT 8))"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT k.r, k.vec_id, k.p, c.c, list_sum(list_transform(list_zip(k.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM kept k CROSS JOIN c{n} c QUALIFY row_number() OVER (PARTITION BY k.r ORDER BY d, c.c) = 1)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(p) AS x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY c, i),
n{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p FROM m{n} GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c.c, coalesce(x.p, c.p) AS p FROM c{n} c LEFT JOIN n{n} x ON x.c = c.c)""")
    last = rounds
    return "WITH " + ",".join(steps) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON c.c = a.c
"""


def sql() -> dict[str, str]:
    return {
        "op10_prefix_tree_join": NGRAM_JOIN,
        "op11_merkle_climb": MERKLE,
        "op13_threshold_centroids": _centroids(),
    }
