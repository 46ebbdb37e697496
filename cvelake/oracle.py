"""Independent DuckDB SQL for each registered query.

The SQL never replays the Spark code: it derives each answer straight from
the driver tables with the fixture formulas (see cvelake/sources/fixtures.py)
and the documented table semantics, so a bug in the JSON path, the dedup
order or a join shows up as a mismatch.

Run r in {1, 2}: run 1 loaded snapshot 1 only; run 2 re-loaded snapshot 1
and added snapshot 2 (documents with n % 4 = 0), which wins the run-2 tie.
"""

from __future__ import annotations

RUN_TS = {1: "2024-01-15 06:00:00", 2: "2024-01-16 06:00:00"}
AS_OF = "DATE '2024-03-01'"
NVD_FILE = {1: "nvd_modified_2024-01-15.json.gz", 2: "nvd_modified_2024-01-16.json.gz"}
EPSS_FILE = {1: "epss_2024-01-15.csv", 2: "epss_2024-01-16.csv"}


def _cve(n: str) -> str:
    return (f"(CASE WHEN {n} % 97 = 0 THEN 'cve-' ELSE 'CVE-' END || CAST(2020 + {n} % 5 AS VARCHAR) "
            f"|| '-' || printf('%05d', {n}))")


def _sev(x: str) -> str:
    return (f"CASE WHEN {x} = 0 THEN 'NONE' WHEN {x} < 4 THEN 'LOW' WHEN {x} < 7 THEN 'MEDIUM' "
            f"WHEN {x} < 9 THEN 'HIGH' ELSE 'CRITICAL' END")


def _tier(x: str) -> str:
    return f"CASE WHEN {x} >= 90 THEN 'CRITICAL' WHEN {x} >= 70 THEN 'HIGH' WHEN {x} >= 40 THEN 'MEDIUM' ELSE 'LOW' END"


IDS = f"""
ids AS (SELECT doc_id AS n, text, lang, {_cve('doc_id')} AS cve_id FROM documents)"""

KEV = f"""
kev AS (
  SELECT {_cve('doc_id')} AS cve_id,
    CASE WHEN doc_id % 17 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) END AS kev_date_added,
    DATE '2024-01-01' + CAST(doc_id % 60 + 21 AS INTEGER) AS kev_due_date,
    CASE WHEN doc_id % 2 = 0 THEN 'Known' ELSE 'Unknown' END AS kev_ransomware_use,
    'Advisory ' || CAST(doc_id AS VARCHAR) AS kev_notes
  FROM labels WHERE toxic = 1
)"""


def silver_blocks(r: int) -> list[str]:
    """CTEs core_all{r}, core{r}, signals{r}, products_all{r}, products{r},
    plist{r}, docs_all{r}, docs{r} for the state after run r."""
    v2 = "TRUE" if r == 2 else "FALSE"
    core = f"""
lv{r} AS (
  SELECT *, CASE WHEN n % 4 = 0 AND {v2} THEN 2 ELSE 1 END AS v,
         (n % 101) / CAST(10 AS DOUBLE) AS s1
  FROM ids
),
lvs{r} AS (
  SELECT *, CASE WHEN v = 2 THEN least(s1 + CAST(0.1 AS DOUBLE), CAST(10 AS DOUBLE)) ELSE s1 END AS s,
         (v = 1 AND n % 89 = 0) AS legacy
  FROM lv{r}
),
core_all{r} AS (
  SELECT cve_id, n, v,
    CASE WHEN legacy THEN NULL ELSE CAST(DATE '2024-01-01' + CAST(n % 365 AS INTEGER) AS TIMESTAMP) END AS published,
    CASE WHEN legacy THEN NULL
         WHEN v = 2 THEN TIMESTAMP '2024-01-16 08:00:00'
         WHEN n % 53 = 0 THEN NULL
         ELSE CAST(DATE '2024-01-01' + CAST(n % 365 + n % 13 AS INTEGER) AS TIMESTAMP) + INTERVAL 750 MINUTE
    END AS last_modified,
    CASE WHEN lang = 'en' AND NOT (v = 2 AND n % 28 = 0) AND NOT legacy THEN text END AS description,
    CASE WHEN n % 3 IN (0, 1) AND NOT legacy THEN s END AS cvss_v3_score,
    CASE WHEN n % 3 IN (0, 1) AND NOT legacy THEN {_sev('s')} END AS cvss_v3_severity,
    CASE WHEN legacy THEN NULL
         WHEN n % 3 = 0 THEN 'CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H'
         WHEN n % 3 = 1 THEN 'CVSS:3.0/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H' END AS cvss_v3_vector,
    CASE WHEN n % 4 = 0 AND NOT legacy THEN CAST(n % 11 AS DOUBLE) END AS cvss_v2_score,
    CASE WHEN n % 5 <> 0 AND n % 49 <> 0 AND NOT legacy THEN 'CWE-' || CAST(n % 40 AS VARCHAR) END AS cwe_id
  FROM lvs{r}
),
core{r} AS (
  SELECT cve_id, published, last_modified, description, cvss_v3_score, cvss_v3_severity,
         cvss_v3_vector, cvss_v2_score, cwe_id
  FROM core_all{r} WHERE description IS NOT NULL
)"""
    signals = f"""
epss{r} AS (
  SELECT cve_id, n,
    CASE WHEN n % 6 = 0 AND {v2} THEN ((n * 7919 + 500) % 1000) / CAST(1000 AS DOUBLE)
         WHEN n % 211 = 0 THEN CAST(1.5 AS DOUBLE)
         WHEN n % 67 = 0 THEN NULL
         ELSE ((n * 7919) % 1000) / CAST(1000 AS DOUBLE) END AS epss_score,
    ((n * 31) % 1000) / CAST(1000 AS DOUBLE) AS epss_percentile
  FROM ids WHERE n % 10 <> 9
),
signals{r} AS (
  SELECT coalesce(e.cve_id, k.cve_id) AS cve_id, e.epss_score, e.epss_percentile,
         k.cve_id IS NOT NULL AS kev_flag, k.kev_date_added, k.kev_due_date, k.kev_ransomware_use, k.kev_notes
  FROM epss{r} e FULL OUTER JOIN kev k ON e.cve_id = k.cve_id
)"""
    products = f"""
cpe_k{r} AS (
  SELECT i.cve_id, i.n, k.k, (i.n * 7 + k.k * 13) % (SELECT count(*) FROM part) AS pk
  FROM ids i, LATERAL (SELECT unnest(range(0, CAST(i.n % 4 AS INTEGER) + 1)) AS k) k
  WHERE i.n % 89 <> 0 OR (i.n % 4 = 0 AND {v2})
),
cpe_rows{r} AS (
  SELECT c.cve_id, c.n, c.k,
    CASE WHEN (c.n + c.k) % 11 = 0 THEN '*'
         WHEN p.p_partkey % 5 = 1 THEN lower(replace(p.p_brand, '#', '-'))
         WHEN p.p_partkey % 5 = 3 THEN lower(replace(p.p_brand, '#', '_')) || '_software.inc'
         ELSE lower(replace(p.p_brand, '#', '_')) END AS vraw,
    CASE WHEN (c.n + c.k) % 13 = 0 THEN '-' ELSE replace(p.p_name, ' ', '_') END AS praw,
    CAST(p.p_size AS VARCHAR) AS version
  FROM cpe_k{r} c JOIN part p ON p.p_partkey = c.pk
  WHERE (c.n + c.k) % 5 <> 0
),
products_all{r} AS (
  SELECT DISTINCT cve_id, n,
    'cpe:2.3:a:' || vraw || ':' || praw || ':' || version || ':*:*:*:*:*:*:*' AS cpe_uri,
    CASE WHEN vraw IN ('*', '-', '') THEN NULL ELSE vraw END AS vendor,
    CASE WHEN praw IN ('*', '-', '') THEN NULL ELSE praw END AS product,
    CASE WHEN version IN ('*', '-', '') THEN NULL ELSE version END AS version
  FROM cpe_rows{r}
),
products{r} AS (
  SELECT cve_id, cpe_uri, vendor, product, version FROM products_all{r} WHERE vendor IS NOT NULL
)"""
    docs = f"""
plist{r} AS (
  SELECT cve_id,
    coalesce(string_agg(DISTINCT vendor, ' | ' ORDER BY vendor), '') AS vendors_str,
    coalesce(string_agg(DISTINCT product, ' | ' ORDER BY product), '') AS products_str
  FROM products{r} GROUP BY cve_id
),
docs_all{r} AS (
  SELECT c.cve_id,
    concat_ws(' | ', c.description,
      CASE WHEN pl.vendors_str <> '' THEN 'Affected vendors: ' || pl.vendors_str END,
      CASE WHEN pl.products_str <> '' THEN 'Affected products: ' || pl.products_str END,
      CASE WHEN c.cwe_id <> '' THEN 'Weakness: ' || c.cwe_id END) AS document_text,
    c.published, c.cvss_v3_score, c.cvss_v3_severity, s.epss_score,
    coalesce(s.kev_flag, false) AS kev_flag, pl.vendors_str, pl.products_str, c.cwe_id
  FROM core{r} c LEFT JOIN signals{r} s ON c.cve_id = s.cve_id LEFT JOIN plist{r} pl ON c.cve_id = pl.cve_id
),
docs{r} AS (SELECT * FROM docs_all{r} WHERE length(document_text) > 50)"""
    return [core, signals, products, docs]


GOLD = f"""
pv AS (
  SELECT cve_id, vendor AS primary_vendor FROM (
    SELECT cve_id, vendor, row_number() OVER (PARTITION BY cve_id ORDER BY cnt DESC, vendor) AS rn
    FROM (SELECT cve_id, vendor, count(*) AS cnt FROM products2 WHERE vendor IS NOT NULL GROUP BY 1, 2)
  ) WHERE rn = 1
),
pp AS (
  SELECT cve_id, product AS primary_product FROM (
    SELECT cve_id, product, row_number() OVER (PARTITION BY cve_id ORDER BY cnt DESC, product) AS rn
    FROM (SELECT cve_id, product, count(*) AS cnt FROM products2 WHERE product IS NOT NULL GROUP BY 1, 2)
  ) WHERE rn = 1
),
enr0 AS (
  SELECT c.cve_id, c.published, c.last_modified, c.description, c.cvss_v3_score, c.cvss_v3_severity,
    c.cvss_v3_vector, c.cvss_v2_score, c.cwe_id, s.epss_score, s.epss_percentile,
    coalesce(s.kev_flag, false) AS kev_flag, s.kev_date_added, s.kev_due_date, s.kev_ransomware_use, s.kev_notes,
    pv.primary_vendor, pp.primary_product
  FROM core2 c LEFT JOIN signals2 s ON c.cve_id = s.cve_id
  LEFT JOIN pv ON c.cve_id = pv.cve_id LEFT JOIN pp ON c.cve_id = pp.cve_id
),
enr1 AS (
  SELECT *, CASE
      WHEN kev_flag THEN 90 + coalesce(epss_score, 0) * 10
      WHEN coalesce(epss_score, 0) > 0.5 THEN 70 + coalesce(epss_score, 0) * 20
      WHEN coalesce(epss_score, 0) > 0.1 THEN 40 + coalesce(epss_score, 0) * 50
      ELSE coalesce(cvss_v3_score, 0) * 4 END AS risk_score
  FROM enr0
),
enriched AS (SELECT *, {_tier('risk_score')} AS risk_tier FROM enr1),
vra AS (
  SELECT p.vendor, count(*) AS total_cves,
    count(*) FILTER (WHERE e.kev_flag) AS kev_count,
    count(*) FILTER (WHERE e.risk_tier = 'CRITICAL') AS critical_count,
    count(*) FILTER (WHERE e.risk_tier = 'HIGH') AS high_count,
    CAST(sum(CAST(round(e.risk_score * 1000000) AS BIGINT)) AS DOUBLE) / count(*) / 1000000 AS avg_risk_score,
    max(e.risk_score) AS max_risk_score
  FROM (SELECT DISTINCT cve_id, vendor FROM products2 WHERE vendor IS NOT NULL) p
  JOIN enriched e ON p.cve_id = e.cve_id
  GROUP BY p.vendor
)"""


def _metric(r: int, table: str, rule: str, action: str, src: str, cond: str) -> str:
    return (f"SELECT TIMESTAMP '{RUN_TS[r]}' AS run_ts, '{table}' AS tbl, '{rule}' AS rule, '{action}' AS action, "
            f"count(*) AS total, count(*) FILTER (WHERE coalesce({cond}, false)) AS passed FROM {src}")


def metrics_block(r: int) -> str:
    fmt = "regexp_matches(cve_id, '^CVE-[0-9]{4}-[0-9]+$')"
    parts = [
        _metric(r, "cve_core", "valid_cve_id", "warn", f"core_all{r}", "cve_id IS NOT NULL"),
        _metric(r, "cve_core", "valid_cve_format", "warn", f"core_all{r}", fmt),
        _metric(r, "cve_core", "has_description", "drop", f"core_all{r}", "description IS NOT NULL"),
        _metric(r, "cve_signals", "valid_epss_range", "warn", f"signals{r}",
                "epss_score IS NULL OR (epss_score >= 0 AND epss_score <= 1)"),
        _metric(r, "cve_affected_products", "valid_cve_id", "warn", f"products_all{r}", "cve_id IS NOT NULL"),
        _metric(r, "cve_affected_products", "valid_cpe_uri", "warn", f"products_all{r}", "cpe_uri IS NOT NULL"),
        _metric(r, "cve_affected_products", "has_vendor", "drop", f"products_all{r}", "vendor IS NOT NULL"),
        _metric(r, "cve_documents", "valid_cve_id", "warn", f"docs_all{r}", "cve_id IS NOT NULL"),
        _metric(r, "cve_documents", "has_document_text", "drop", f"docs_all{r}", "length(document_text) > 50"),
    ]
    union = "\n  UNION ALL ".join(parts)
    return f"""
m0_{r} AS ({union}),
metrics{r} AS (
  SELECT run_ts, tbl AS "table", rule, action, total, passed, total - passed AS failed,
    CASE WHEN action = 'drop' THEN total - passed ELSE 0 END AS dropped,
    passed / total AS pass_rate
  FROM m0_{r}
)"""


_SPOKEN = """CASE conv_id % 3 WHEN 0 THEN 'Brand ' || CAST(conv_id % 25 + 1 AS VARCHAR) || ' Software, Inc.'
        WHEN 1 THEN 'Brand-' || CAST(conv_id % 25 + 1 AS VARCHAR) ELSE 'brand_' || CAST(conv_id % 25 + 1 AS VARCHAR) END"""

QUESTIONS = f"""
qraw AS (
  SELECT (conv_id * 1000 + turn) * 2 AS question_id, text AS raw_query FROM conversations
  UNION ALL
  SELECT (conv_id * 1000 + turn) * 2 + 1,
    CASE (conv_id + turn) % 7
      WHEN 0 THEN 'What is ' || {_cve('conv_id')} || '?'
      WHEN 1 THEN 'Compare ' || {_cve('conv_id')} || ' and ' || {_cve('(conv_id + 1)')}
      WHEN 2 THEN 'Critical vulns in ' || {_SPOKEN} || ' since 2024-01-' || printf('%02d', conv_id % 28 + 1)
      WHEN 3 THEN 'Latest critical or high vulns in ' || {_SPOKEN} || ' in the last '
                  || CAST(conv_id % 120 + 1 AS VARCHAR) || ' days'
      WHEN 4 THEN 'What''s exploited this month?'
      WHEN 5 THEN 'KEV vulnerabilities affecting ' || {_SPOKEN} || ' in the last '
                  || CAST(conv_id % 90 + 1 AS VARCHAR) || ' days'
      ELSE '' END
  FROM conversations
),
qtok AS (
  SELECT question_id, raw_query,
    list_filter(string_split(regexp_replace(lower(coalesce(raw_query, '')), '[^a-z0-9_]+', ' ', 'g'), ' '), lambda t: t <> '') AS tok,
    list_sort(list_distinct(list_transform(
      regexp_extract_all(coalesce(raw_query, ''), '(?i)CVE-[0-9]{{4}}-[0-9]+'), lambda x: upper(x)))) AS cve_ids
  FROM qraw
),
qpad AS (SELECT *, ' ' || array_to_string(tok, ' ') || ' ' AS pad FROM qtok),
known AS (SELECT DISTINCT lower(vendor) AS v FROM products2 WHERE vendor IS NOT NULL),
qwords AS (
  SELECT question_id, ' ' || trim(regexp_replace(lower(coalesce(raw_query, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS words FROM qraw
),
qvend AS (
  SELECT question_id, list_sort(list(DISTINCT v)) AS vendors
  FROM qwords JOIN known ON contains(words, ' ' || trim(regexp_replace(v, '[^a-z0-9]+', ' ', 'g')) || ' ')
  WHERE trim(regexp_replace(v, '[^a-z0-9]+', ' ', 'g')) <> ''
  GROUP BY question_id
),
qflags AS (
  SELECT q.*, coalesce(qv.vendors, []::VARCHAR[]) AS vendors,
    list_has_any(tok, ['compare', 'comparison', 'versus', 'vs']) AS w_cmp,
    list_has_any(tok, ['recent', 'new', 'latest', 'trending', 'exploited'])
      OR pad LIKE '% this month %' OR pad LIKE '% this week %' AS w_trend,
    list_has_any(tok, ['kev', 'exploited', 'cisa']) OR pad LIKE '% known exploited %' AS kev_only,
    list_sort(list_transform(list_filter(['critical', 'high', 'medium', 'low'], lambda x: list_contains(tok, x)),
      lambda x: upper(x))) AS risk_tiers,
    regexp_extract(pad, ' last ([0-9]+) days ', 1) AS last_n,
    regexp_extract(lower(coalesce(raw_query, '')), 'since ([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) AS since
  FROM qpad q LEFT JOIN qvend qv ON q.question_id = qv.question_id
),
parsed AS (
  SELECT question_id, raw_query, cve_ids, risk_tiers, kev_only, vendors,
    CASE
      WHEN len(tok) = 0 AND len(cve_ids) = 0 THEN 'UNKNOWN'
      WHEN len(cve_ids) = 1 THEN 'CVE_LOOKUP'
      WHEN len(cve_ids) > 1 OR w_cmp THEN 'COMPARISON'
      WHEN w_trend THEN 'TREND_ANALYSIS'
      WHEN len(risk_tiers) > 0 OR kev_only OR len(vendors) > 0 THEN 'FILTERED_SEARCH'
      ELSE 'SEMANTIC_SEARCH' END AS intent,
    coalesce(
      TRY_CAST(nullif(since, '') AS DATE),
      CASE WHEN last_n <> '' THEN greatest({AS_OF} - CAST(least(coalesce(TRY_CAST(last_n AS BIGINT), 738000), 738000) AS INTEGER), DATE '0001-01-01') END,
      CASE WHEN pad LIKE '% this week %' THEN {AS_OF} - 7 END,
      CASE WHEN pad LIKE '% this month %' THEN {AS_OF} - 30 END) AS date_from
  FROM qflags
),
qids AS (SELECT question_id, intent, unnest(cve_ids) AS cve_id FROM parsed WHERE intent IN ('CVE_LOOKUP', 'COMPARISON'))"""


TREND_QUESTIONS = f"""
tq AS (SELECT question_id, coalesce(date_from, {AS_OF} - 30) AS since, vendors, risk_tiers
       FROM parsed WHERE intent = 'TREND_ANALYSIS')"""


def with_(*blocks: str) -> str:
    return "WITH " + ",".join(blocks)


S1 = [IDS, KEV, *silver_blocks(1)]
S2 = [IDS, KEV, *silver_blocks(2)]
S12 = [IDS, KEV, *silver_blocks(1), *silver_blocks(2)]
G = [*S2, GOLD]
Q = [*G, QUESTIONS]


def _rationale() -> str:
    return ("concat_ws('; ', CASE WHEN kev_flag THEN 'actively exploited (KEV)' END, "
            "CASE WHEN kev_ransomware_use = 'Known' THEN 'known ransomware use' END, "
            "CASE WHEN epss_score IS NOT NULL THEN 'EPSS ' || CAST(round(epss_score * 100, 1) AS VARCHAR) || '%' END, "
            "CASE WHEN cvss_v3_score IS NOT NULL THEN 'CVSS ' || CAST(round(cvss_v3_score, 1) AS VARCHAR) END)")


DOC_COLS = ("document_text", "published", "cvss_v3_score", "cvss_v3_severity", "epss_score", "kev_flag",
            "vendors_str", "products_str", "cwe_id")


def _diff() -> str:
    cols = ", ".join(DOC_COLS)
    o_cols = ", ".join(f"o.{c}" for c in DOC_COLS)
    n_cols = ", ".join(f"n.{c}" for c in DOC_COLS)
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in DOC_COLS)
    return f"""
SELECT cve_id, {cols}, 'insert' AS _change_type FROM docs2 n
  WHERE NOT EXISTS (SELECT 1 FROM docs1 o WHERE o.cve_id = n.cve_id)
UNION ALL
SELECT cve_id, {cols}, 'delete' AS _change_type FROM docs1 o
  WHERE NOT EXISTS (SELECT 1 FROM docs2 n WHERE o.cve_id = n.cve_id)
UNION ALL
SELECT o.cve_id, {o_cols}, 'update_preimage' FROM docs1 o JOIN docs2 n ON o.cve_id = n.cve_id WHERE {changed}
UNION ALL
SELECT n.cve_id, {n_cols}, 'update_postimage' FROM docs1 o JOIN docs2 n ON o.cve_id = n.cve_id WHERE {changed}"""


def _trend() -> str:
    return """
hist AS (SELECT * FROM metrics1 UNION ALL SELECT * FROM metrics2),
trend AS (
  SELECT run_ts, "table", rule, failed, failed / total AS failure_rate,
    lag(failed / total) OVER (PARTITION BY "table", rule ORDER BY run_ts) AS prev_failure_rate
  FROM hist
),
trend2 AS (SELECT *, coalesce(failure_rate > prev_failure_rate, false) AS rising FROM trend)"""


# Winning Bronze file per Silver record of run 2 (for failure attribution).
FILES2 = f"""
core_f AS (SELECT *, CASE WHEN v = 2 THEN '{NVD_FILE[2]}' ELSE '{NVD_FILE[1]}' END AS source_file FROM core_all2),
epss_f AS (SELECT *, CASE WHEN n % 6 = 0 THEN '{EPSS_FILE[2]}' ELSE '{EPSS_FILE[1]}' END AS source_file FROM epss2),
prod_f AS (SELECT *, CASE WHEN n % 4 = 0 THEN '{NVD_FILE[2]}' ELSE '{NVD_FILE[1]}' END AS source_file FROM products_all2),
fails AS (
  SELECT 'cve_core' AS tbl, 'valid_cve_id' AS rule, source_file, count(*) FILTER (WHERE cve_id IS NULL) AS failed FROM core_f GROUP BY 3
  UNION ALL SELECT 'cve_core', 'valid_cve_format', source_file,
    count(*) FILTER (WHERE NOT coalesce(regexp_matches(cve_id, '^CVE-[0-9]{{4}}-[0-9]+$'), false)) FROM core_f GROUP BY 3
  UNION ALL SELECT 'cve_core', 'has_description', source_file, count(*) FILTER (WHERE description IS NULL) FROM core_f GROUP BY 3
  UNION ALL SELECT 'cve_signals', 'valid_epss_range', source_file,
    count(*) FILTER (WHERE NOT (epss_score IS NULL OR (epss_score >= 0 AND epss_score <= 1))) FROM epss_f GROUP BY 3
  UNION ALL SELECT 'cve_affected_products', 'valid_cve_id', source_file, count(*) FILTER (WHERE cve_id IS NULL) FROM prod_f GROUP BY 3
  UNION ALL SELECT 'cve_affected_products', 'valid_cpe_uri', source_file, count(*) FILTER (WHERE cpe_uri IS NULL) FROM prod_f GROUP BY 3
  UNION ALL SELECT 'cve_affected_products', 'has_vendor', source_file, count(*) FILTER (WHERE vendor IS NULL) FROM prod_f GROUP BY 3
),
nfiles AS (SELECT tbl, rule, count(*) AS files_with_failures FROM fails WHERE failed > 0 GROUP BY 1, 2)"""


VEC = f"""
vec AS (SELECT vec_id, label, {_cve('vec_id')} AS cve_id, CAST(embedding AS DOUBLE[]) AS ev FROM embeddings),
cand AS (
  SELECT v.cve_id, v.ev, d.cvss_v3_score, d.kev_flag, e.description, e.risk_tier
  FROM vec v JOIN docs2 d ON v.cve_id = d.cve_id LEFT JOIN enriched e ON v.cve_id = e.cve_id
),
qvec AS (SELECT ev AS qv FROM vec WHERE vec_id = 0)"""


def _vec_topk(where: str) -> str:
    return with_(*G, VEC) + f"""
 , scored AS (
   SELECT c.*, list_dot_product(c.ev, q.qv) / (sqrt(list_dot_product(c.ev, c.ev)) * sqrt(list_dot_product(q.qv, q.qv))) AS s
   FROM cand c, qvec q WHERE {where})
 SELECT CAST(row_number() OVER (ORDER BY round(s, 9) DESC NULLS LAST, cve_id) AS INTEGER) AS rank,
   cve_id, round(s, 6) AS score, description, risk_tier, kev_flag, cvss_v3_score
 FROM scored ORDER BY round(s, 9) DESC NULLS LAST, cve_id LIMIT 10"""


def _tfidf(queries: str, where: str = "TRUE", hit: bool = False) -> str:
    tok = "list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9_]+', ' ', 'g'), ' '), lambda t: t <> '')"
    return f"""
 , dt AS (SELECT cve_id AS id, unnest({tok.format(x='document_text')}) AS term FROM docs2),
 dtf AS (SELECT id, term, count(*) AS tf FROM dt GROUP BY 1, 2),
 idf AS (
   SELECT term, ln(CAST((SELECT count(*) FROM docs2) + 1 AS DOUBLE) / (count(*) + 1)) AS idf
   FROM dtf GROUP BY term),
 dw AS (SELECT d.id, d.term, d.tf * i.idf AS w FROM dtf d JOIN idf i ON d.term = i.term WHERE i.idf > 0),
 dn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM dw),
 qsrc AS ({queries}),
 qt AS (SELECT qid, unnest({tok.format(x='qtext')}) AS term FROM qsrc),
 qtf AS (SELECT qid, term, count(*) AS tf FROM qt GROUP BY 1, 2),
 qw AS (SELECT q.qid, q.term, q.tf * i.idf AS w FROM qtf q JOIN idf i ON q.term = i.term WHERE i.idf > 0),
 qn AS (SELECT qid, term, w / sqrt(sum(w * w) OVER (PARTITION BY qid)) AS w FROM qw),
 sc AS (SELECT qn.qid, dn.id, sum(qn.w * dn.w) AS s FROM qn JOIN dn ON qn.term = dn.term WHERE {where} GROUP BY 1, 2),
 rk AS (SELECT qid, id, s, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS INTEGER) AS rank FROM sc)
 SELECT qid AS query_id, rank, id AS cve_id, round(s, 6) AS score{", e.description, e.risk_tier, e.kev_flag, e.cvss_v3_score" if hit else ""}
 FROM rk {"LEFT JOIN enriched e ON e.cve_id = rk.id" if hit else ""} WHERE rank <= 5"""


def _text_vectors(queries: str) -> str:
    """dv and qv: (id, place, w), the unit vectors of documents and queries."""
    tok = "list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9_]+', ' ', 'g'), ' '), lambda t: t <> '')"
    sums = """
 SELECT {id}, CAST(('0x' || substr(md5(term), 1, 8))::BIGINT % 256 AS INTEGER) AS place,
   sum(CASE WHEN substr(md5(term), 9, 1) < '8' THEN w ELSE -w END) AS v FROM {of} GROUP BY 1, 2"""
    return f"""
 , dt AS (SELECT cve_id AS id, unnest({tok.format(x='document_text')}) AS term FROM docs2),
 dtf AS (SELECT id, term, count(*) AS tf FROM dt GROUP BY 1, 2),
 idf AS (
   SELECT term, ln(CAST((SELECT count(*) FROM docs2) + 1 AS DOUBLE) / (count(*) + 1)) AS idf
   FROM dtf GROUP BY term),
 dw AS (SELECT d.id, d.term, d.tf * i.idf AS w FROM dtf d JOIN idf i ON d.term = i.term WHERE i.idf > 0),
 qsrc AS ({queries}),
 qt AS (SELECT qid, unnest({tok.format(x='qtext')}) AS term FROM qsrc),
 qtf AS (SELECT qid, term, count(*) AS tf FROM qt GROUP BY 1, 2),
 qw AS (SELECT q.qid, q.term, q.tf * i.idf AS w FROM qtf q JOIN idf i ON q.term = i.term WHERE i.idf > 0),
 ds AS ({sums.format(id="id", of="dw")}), qs AS ({sums.format(id="qid", of="qw")}),
 dv AS (SELECT id, place, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM ds WHERE v <> 0),
 qv AS (SELECT qid, place, v / sqrt(sum(v * v) OVER (PARTITION BY qid)) AS w FROM qs WHERE v <> 0)"""


_FEED_ROWS = """
   SELECT 'nvd' AS source, DATE '2024-01-15' AS snapshot_date FROM documents
   UNION ALL SELECT 'nvd', DATE '2024-01-16' FROM documents WHERE doc_id % 4 = 0
   UNION ALL SELECT 'kev', DATE '2024-01-15' FROM labels WHERE toxic = 1
   UNION ALL SELECT 'epss', DATE '2024-01-15' FROM documents WHERE doc_id % 10 <> 9
   UNION ALL SELECT 'epss', DATE '2024-01-16' FROM documents WHERE doc_id % 10 <> 9 AND doc_id % 6 = 0"""


def sql() -> dict[str, str]:
    out = {
        "cve_core_latest": with_(*S2) + " SELECT * FROM core2",
        "cve_signals": with_(*S2) + " SELECT * FROM signals2",
        "affected_products": with_(*S2) + " SELECT * FROM products2",
        "cve_documents": with_(*S2) + " SELECT * FROM docs2",
        "as_of_core": with_(*S1) + " SELECT * FROM core1",
        "bronze_ingest": f"""
 WITH src AS ({_FEED_ROWS})
 SELECT source, snapshot_date, count(*) AS records FROM src GROUP BY ROLLUP (source, snapshot_date)""",
        "core_from_files": with_(*S2) + " SELECT * FROM core2",
        "signals_from_files": with_(*S2) + " SELECT * FROM signals2",
        "file_validation": """
 SELECT 'nvd' AS kind, true AS all_ok, true AS counts_match,
   (SELECT count(*) FROM documents) + (SELECT count(*) FROM documents WHERE doc_id % 4 = 0) AS n_records
 UNION ALL SELECT 'kev', true, true, (SELECT count(*) FROM labels WHERE toxic = 1)
 UNION ALL SELECT 'epss', true, true,
   (SELECT count(*) FROM documents WHERE doc_id % 10 <> 9)
   + (SELECT count(*) FROM documents WHERE doc_id % 10 <> 9 AND doc_id % 6 = 0)""",
        "snapshot_diff": with_(*S12) + _diff(),
        "dq_metrics": with_(*S2, metrics_block(2)) + " SELECT * FROM metrics2",
        "dq_severity": with_(*S2, metrics_block(2)) + """
 SELECT run_ts, "table", rule, action, failed, failed / total AS failure_rate,
   CASE WHEN failed / total < 0.001 THEN 'LOW' WHEN failed / total <= 0.01 THEN 'MEDIUM'
        WHEN failed / total > 0.01 THEN 'HIGH' END AS severity
 FROM metrics2""",
        "dq_trend": with_(*S12, metrics_block(1), metrics_block(2), _trend()) + " SELECT * FROM trend2",
        "dq_escalation": with_(*S12, metrics_block(1), metrics_block(2), _trend(), FILES2) + """
 SELECT t."table", t.rule, m.action, t.failed, t.failure_rate, t.rising,
   coalesce(nf.files_with_failures, 0) AS files_with_failures,
   CASE WHEN m.action = 'drop' AND m.dropped / m.total > 0.05 THEN 'CRITICAL'
        WHEN t.rising THEN 'HIGH'
        WHEN t.failed >= 10 AND coalesce(nf.files_with_failures, 0) = 1 THEN 'MEDIUM'
        WHEN t.failed < 10 THEN 'LOW' ELSE 'MEDIUM' END AS escalation
 FROM trend2 t JOIN metrics2 m ON t.run_ts = m.run_ts AND t."table" = m."table" AND t.rule = m.rule
 LEFT JOIN nfiles nf ON nf.tbl = t."table" AND nf.rule = t.rule""",
        "dq_by_snapshot": with_(IDS) + """
 SELECT DATE '2024-01-15' AS snapshot_date, 2 * count(*) AS total_records,
   2 * count(*) FILTER (WHERE NOT coalesce(lang = 'en' AND text IS NOT NULL, false) OR n % 89 = 0) AS would_drop
 FROM ids
 UNION ALL
 SELECT DATE '2024-01-16', count(*),
   count(*) FILTER (WHERE NOT coalesce(lang = 'en' AND text IS NOT NULL, false) OR n % 28 = 0)
 FROM ids WHERE n % 4 = 0""",
        "malformed_ids": with_(IDS) + f"""
 SELECT cve_id, '{NVD_FILE[1]}' AS source_file, DATE '2024-01-15' AS snapshot_date, TIMESTAMP '{RUN_TS[1]}' AS ingest_ts
 FROM ids WHERE n % 97 = 0
 UNION ALL SELECT cve_id, '{NVD_FILE[1]}', DATE '2024-01-15', TIMESTAMP '{RUN_TS[2]}' FROM ids WHERE n % 97 = 0
 UNION ALL SELECT cve_id, '{NVD_FILE[2]}', DATE '2024-01-16', TIMESTAMP '{RUN_TS[2]}' FROM ids WHERE n % 97 = 0 AND n % 4 = 0""",
        "dq_length_check": with_(*S2) + """
 SELECT count(*) FILTER (WHERE length(c.description) <= 50) AS would_fail
 FROM core2 c LEFT JOIN signals2 s ON c.cve_id = s.cve_id""",
        "bronze_file_counts": f"""
 SELECT 'nvd' AS source, '{NVD_FILE[1]}' AS source_file, DATE '2024-01-15' AS snapshot_date, 2 * count(*) AS records FROM documents
 UNION ALL SELECT 'nvd', '{NVD_FILE[2]}', DATE '2024-01-16', count(*) FROM documents WHERE doc_id % 4 = 0
 UNION ALL SELECT 'kev', 'cisa_kev_2024-01-15.json', DATE '2024-01-15', 2 * count(*) FROM labels WHERE toxic = 1
 UNION ALL SELECT 'epss', '{EPSS_FILE[1]}', DATE '2024-01-15', 2 * count(*) FROM documents WHERE doc_id % 10 <> 9
 UNION ALL SELECT 'epss', '{EPSS_FILE[2]}', DATE '2024-01-16', count(*) FROM documents
   WHERE doc_id % 10 <> 9 AND doc_id % 6 = 0""",
        "distinct_vendors": with_(*S2) + " SELECT DISTINCT vendor FROM products2",
        "core_by_month": with_(*S2) + """
 SELECT CAST(year(published) AS INTEGER) AS year, CAST(month(published) AS INTEGER) AS month, count(*) AS cves
 FROM core2 GROUP BY 1, 2""",
        "index_sync": with_(*S2) + " SELECT cve_id, CAST(length(document_text) AS INTEGER) AS text_length, kev_flag, cvss_v3_score FROM docs2",
        "continuous_index_sync": with_(*S2) + " SELECT cve_id, CAST(length(document_text) AS INTEGER) AS text_length, kev_flag, cvss_v3_score FROM docs2",
        "vuln_enriched": with_(*G) + " SELECT * FROM enriched",
        "vendor_risk_agg": with_(*G) + " SELECT * FROM vra",
        "build_job": with_(*G) + " SELECT * FROM vra",
        "kev_recent": with_(*G) + f"""
 SELECT *, CAST({AS_OF} - kev_date_added AS INTEGER) AS days_since_added FROM enriched
 WHERE kev_flag AND kev_date_added BETWEEN {AS_OF} - 30 AND {AS_OF}""",
        "gold_quality": with_(*G) + f"""
 SELECT TIMESTAMP '{RUN_TS[2]}' AS run_ts, 'vuln_enriched' AS "table", rule, 'warn' AS action, total, passed,
   total - passed AS failed, 0::BIGINT AS dropped, passed / total AS pass_rate
 FROM (
   SELECT 'risk_score_in_range' AS rule, count(*) AS total,
     count(*) FILTER (WHERE coalesce(risk_score BETWEEN 0 AND 100, false)) AS passed FROM enriched
   UNION ALL
   SELECT 'risk_tier_matches_score', count(*),
     count(*) FILTER (WHERE coalesce(risk_tier = {_tier('risk_score')}, false)) FROM enriched)""",
        "classify_questions": with_(*Q) + """
 SELECT question_id, intent, array_to_string(cve_ids, ',') AS cve_ids,
   array_to_string(risk_tiers, ',') AS risk_tiers, kev_only, array_to_string(vendors, ',') AS vendors,
   date_from, intent = 'SEMANTIC_SEARCH' AS has_search_text
 FROM parsed""",
        "lookup_cve": with_(*Q) + """
 SELECT q.question_id, e.cve_id, e.description, e.cvss_v3_score, e.epss_score, e.kev_flag, e.risk_score,
   e.risk_tier, e.published, e.cwe_id, pl.vendors_str AS vendors, pl.products_str AS products,
   CASE WHEN length(e.description) > 300 THEN substring(e.description, 1, 300) || '...' ELSE e.description END
     AS description_short
 FROM qids q JOIN enriched e ON q.cve_id = e.cve_id LEFT JOIN plist2 pl ON e.cve_id = pl.cve_id
 WHERE q.intent = 'CVE_LOOKUP'""",
        "compare_cves": with_(*Q) + f"""
 , ranked AS (
   SELECT q.question_id,
     CAST(row_number() OVER (PARTITION BY q.question_id ORDER BY e.risk_score DESC NULLS LAST, e.cve_id) AS INTEGER) AS rank,
     e.cve_id, e.risk_score, e.risk_tier,
     concat_ws('; ', CASE WHEN e.kev_flag THEN 'actively exploited (KEV)' END,
       CASE WHEN e.kev_ransomware_use = 'Known' THEN 'known ransomware use' END,
       CASE WHEN e.epss_score IS NOT NULL THEN 'EPSS ' || CAST(round(e.epss_score * 100, 1) AS VARCHAR) || '%' END,
       CASE WHEN e.cvss_v3_score IS NOT NULL THEN 'CVSS ' || CAST(round(e.cvss_v3_score, 1) AS VARCHAR) END) AS rationale
   FROM qids q JOIN enriched e ON q.cve_id = e.cve_id WHERE q.intent = 'COMPARISON')
 SELECT *, CASE WHEN rank = 1 THEN 'Prioritize ' || cve_id || ' because '
   || CASE WHEN rationale = '' THEN 'it has the highest risk score' ELSE rationale END END AS recommendation
 FROM ranked""",
        "not_found_ids": with_(*Q) + """
 SELECT q.cve_id, q.question_id, regexp_matches(q.cve_id, '^CVE-[0-9]{4}-[0-9]+$') AS valid_format
 FROM qids q WHERE NOT EXISTS (SELECT 1 FROM enriched e WHERE e.cve_id = q.cve_id)""",
        "filtered_search": with_(*G) + """
 SELECT cve_id, description, risk_score, risk_tier, kev_flag FROM enriched
 WHERE risk_tier IN ('HIGH', 'CRITICAL', 'MEDIUM')
   AND cve_id IN (SELECT cve_id FROM products2 WHERE lower(vendor) IN ('brand_3', 'brand_11'))
 ORDER BY risk_score DESC NULLS LAST, cve_id LIMIT 25""",
        "filtered_search_all": with_(*G) + """
 SELECT cve_id, description, risk_score, risk_tier, kev_flag FROM enriched
 WHERE risk_tier IN ('LOW', 'MEDIUM', 'HIGH') AND cvss_v3_score >= 2.0 AND epss_score >= 0.1
   AND published >= TIMESTAMP '2024-02-01' AND published < TIMESTAMP '2024-11-16'
   AND cve_id IN (SELECT cve_id FROM products2
     WHERE lower(vendor) IN ('brand_19', 'brand_16', 'brand_21', 'brand_9', 'brand_17', 'brand_15')
       AND lower(product) IN ('red_plate', 'hot_bolt', 'small_ring', 'hot_rod', 'large_gear', 'blue_gear', 'cold_gear'))
 ORDER BY risk_score DESC NULLS LAST, cve_id LIMIT 40""",
        "answer_filtered": with_(*Q) + """
 , cand AS (
   SELECT p.question_id, e.cve_id, e.description, e.risk_score, e.risk_tier, e.kev_flag
   FROM parsed p JOIN enriched e
     ON (len(p.risk_tiers) = 0 OR list_contains(p.risk_tiers, e.risk_tier))
    AND (NOT p.kev_only OR e.kev_flag)
    AND (p.date_from IS NULL OR e.published >= CAST(p.date_from AS TIMESTAMP))
   WHERE p.intent = 'FILTERED_SEARCH'
     AND (len(p.vendors) = 0 OR EXISTS (
       SELECT 1 FROM products2 pr WHERE pr.cve_id = e.cve_id AND list_contains(p.vendors, lower(pr.vendor))))
 ), ranked AS (
   SELECT question_id,
     CAST(row_number() OVER (PARTITION BY question_id ORDER BY risk_score DESC NULLS LAST, cve_id) AS INTEGER) AS rank,
     cve_id, description, risk_score, risk_tier, kev_flag
   FROM cand)
 SELECT * FROM ranked WHERE rank <= 20""",
        "answer_trends": with_(*Q, TREND_QUESTIONS) + f"""
 , cand AS (
   SELECT tq.question_id, e.cve_id, e.kev_date_added, e.risk_score, e.risk_tier,
     CAST(row_number() OVER (PARTITION BY tq.question_id ORDER BY e.kev_date_added DESC, e.cve_id) AS INTEGER) AS rank
   FROM tq JOIN enriched e ON e.kev_flag AND e.kev_date_added >= tq.since AND e.kev_date_added <= {AS_OF}
     AND (len(tq.risk_tiers) = 0 OR list_contains(tq.risk_tiers, e.risk_tier))
   WHERE len(tq.vendors) = 0 OR EXISTS (
     SELECT 1 FROM products2 p WHERE p.cve_id = e.cve_id AND list_contains(tq.vendors, lower(p.vendor))))
 SELECT question_id, rank, cve_id, kev_date_added, risk_score, risk_tier FROM cand WHERE rank <= 20""",
        "answer_trend_vendors": with_(*Q, TREND_QUESTIONS) + f"""
 , cand AS (
   SELECT tq.question_id, p.vendor, count(DISTINCT e.cve_id) AS kev_count
   FROM tq JOIN enriched e ON e.kev_flag AND e.kev_date_added >= tq.since AND e.kev_date_added <= {AS_OF}
     AND (len(tq.risk_tiers) = 0 OR list_contains(tq.risk_tiers, e.risk_tier))
   JOIN (SELECT DISTINCT cve_id, lower(vendor) AS vendor FROM products2 WHERE vendor IS NOT NULL) p ON p.cve_id = e.cve_id
   WHERE len(tq.vendors) = 0 OR list_contains(tq.vendors, p.vendor)
   GROUP BY 1, 2),
 rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id ORDER BY kev_count DESC, vendor) AS INTEGER) AS rank FROM cand)
 SELECT question_id, rank, vendor, kev_count FROM rk WHERE rank <= 5""",
        "trend_vendors": with_(*G) + f"""
 SELECT p.vendor, count(*) AS recent_kev_count
 FROM (SELECT DISTINCT cve_id, vendor FROM products2 WHERE vendor IS NOT NULL) p
 WHERE p.cve_id IN (SELECT cve_id FROM enriched WHERE kev_flag AND kev_date_added BETWEEN {AS_OF} - 30 AND {AS_OF})
 GROUP BY p.vendor""",
        "tier_distribution": with_(*G) + " SELECT risk_tier, count(*) AS cve_count FROM enriched GROUP BY risk_tier",
        "data_stats": with_(*G) + """
 SELECT 'total_cves' AS metric, CAST(count(*) AS DOUBLE) AS value FROM enriched
 UNION ALL SELECT 'kev_count', CAST(count(*) FILTER (WHERE kev_flag) AS DOUBLE) FROM enriched
 UNION ALL SELECT 'critical_count', CAST(count(*) FILTER (WHERE risk_tier = 'CRITICAL') AS DOUBLE) FROM enriched
 UNION ALL SELECT 'avg_risk_score', CAST(sum(CAST(round(risk_score * 1000000) AS BIGINT)) AS DOUBLE) / count(*) / 1000000 FROM enriched
 UNION ALL SELECT 'vendor_count', CAST(count(DISTINCT vendor) AS DOUBLE) FROM products2""",
        "top_vendors": with_(*G) + " SELECT * FROM vra ORDER BY kev_count DESC, avg_risk_score DESC, vendor LIMIT 10",
        "priority_list": with_(*G) + """
 SELECT cve_id, description, risk_score, risk_tier, kev_flag FROM enriched
 WHERE kev_flag AND cvss_v3_score >= 5.0
 ORDER BY risk_score DESC NULLS LAST, cve_id LIMIT 50""",
        "vector_topk": _vec_topk("TRUE"),
        "vector_topk_filtered": _vec_topk("c.cvss_v3_score >= 4.0"),
        "vector_topk_batch": with_(*G, VEC) + """
 , scored AS (
   SELECT q.vec_id, c.cve_id, c.description, c.risk_tier, c.kev_flag, c.cvss_v3_score,
     list_dot_product(c.ev, q.ev) / (sqrt(list_dot_product(c.ev, c.ev)) * sqrt(list_dot_product(q.ev, q.ev))) AS s
   FROM vec q, cand c),
 rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, cve_id) AS INTEGER) AS rank FROM scored)
 SELECT vec_id AS query_id, rank, cve_id, round(s, 6) AS score, description, risk_tier, kev_flag, cvss_v3_score
 FROM rk WHERE rank <= 5""",
        "vector_topk_indexed": with_(*G, VEC) + """
 , scored AS (
   SELECT q.vec_id, c.cve_id, c.description, c.risk_tier, c.kev_flag, c.cvss_v3_score,
     list_dot_product(c.ev, q.ev) / (sqrt(list_dot_product(c.ev, c.ev)) * sqrt(list_dot_product(q.ev, q.ev))) AS s
   FROM vec q, cand c),
 rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, cve_id) AS INTEGER) AS rank FROM scored)
 SELECT vec_id AS query_id, rank, cve_id, round(s, 6) AS score, description, risk_tier, kev_flag, cvss_v3_score
 FROM rk WHERE rank <= 5""",
        "document_vectors": with_(*S2) + _text_vectors("SELECT CAST(NULL AS BIGINT) AS qid, '' AS qtext WHERE false") + """
 SELECT id AS cve_id, place, round(w, 6) AS weight FROM dv WHERE round(w, 6) <> 0""",
        "semantic_text_search": with_(*G) + _text_vectors("SELECT item_id AS qid, text AS qtext FROM benchmark") + """,
 ok AS (SELECT cve_id AS id FROM docs2 WHERE cvss_v3_score >= 2.0),
 sc AS (SELECT qid, dv.id, sum(qv.w * dv.w) AS s FROM qv JOIN dv ON qv.place = dv.place JOIN ok ON ok.id = dv.id GROUP BY 1, 2),
 every AS (SELECT q.qid, ok.id, coalesce(sc.s, 0.0) AS s FROM (SELECT DISTINCT qid FROM qv) q CROSS JOIN
   (SELECT id FROM ok WHERE id IN (SELECT id FROM dv)) ok LEFT JOIN sc ON sc.qid = q.qid AND sc.id = ok.id),
 rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS INTEGER) AS rank FROM every)
 SELECT qid AS query_id, rank, id AS cve_id, round(s, 6) AS score, e.description, e.risk_tier, e.kev_flag, e.cvss_v3_score
 FROM rk LEFT JOIN enriched e ON e.cve_id = rk.id WHERE rank <= 5""",
        "tfidf_search": with_(*S2) + _tfidf("SELECT item_id AS qid, text AS qtext FROM benchmark"),
        "answer_semantic": with_(*Q) + _tfidf(
            "SELECT question_id AS qid, coalesce(raw_query, '') AS qtext FROM parsed WHERE intent = 'SEMANTIC_SEARCH'"),
        "text_search_filtered": with_(*G) + _tfidf(
            "SELECT item_id AS qid, text AS qtext FROM benchmark",
            "id IN (SELECT cve_id FROM docs2 WHERE kev_flag AND cvss_v3_score >= 4.0)", hit=True),
        "search_fallback": with_(*G) + """
 , hits AS (
   SELECT e.*, CAST(row_number() OVER (ORDER BY risk_score DESC NULLS LAST, cve_id) AS INTEGER) AS rank FROM enriched e
   WHERE cve_id IN (SELECT cve_id FROM docs2 WHERE contains(lower(document_text), 'weakness: cwe-1') AND cvss_v3_score >= 2.0))
 SELECT rank, cve_id, CAST(NULL AS DOUBLE) AS score, description, risk_tier, kev_flag, cvss_v3_score FROM hits WHERE rank <= 10""",
        "keyword_fallback": with_(*G) + """
 SELECT cve_id, description, risk_score, risk_tier, kev_flag FROM enriched
 WHERE cve_id IN (SELECT cve_id FROM docs2 WHERE contains(lower(document_text), 'weakness: cwe-1'))
 ORDER BY risk_score DESC NULLS LAST, cve_id LIMIT 10""",
        "incremental_core": with_(*S2) + " SELECT * FROM core2",
        "incremental_products": with_(*S2) + " SELECT * FROM products2",
        "incremental_signals": with_(*S2) + " SELECT * FROM signals2",
        "incremental_events": """
 SELECT user_id, event_id, ts, event_type, value FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "stream_ingest": f"""
 WITH src AS ({_FEED_ROWS})
 SELECT source, snapshot_date, count(*) AS records, CAST(1 AS BIGINT) AS runs FROM src GROUP BY 1, 2""",
        "ingest_odd_files": f"""
 WITH src AS ({_FEED_ROWS}
   UNION ALL SELECT 'nvd', NULL UNION ALL SELECT 'epss', DATE '2024-01-20')
 SELECT source, snapshot_date, count(*) AS records FROM src GROUP BY ROLLUP (source, snapshot_date)""",
        "ingest_report": """
 SELECT * FROM (VALUES
   ('nvd', 'nvd_modified_2024-01-20.json.gz', 'unreadable'),
   ('kev', 'cisa_kev_2024-01-20.json', 'invalid JSON'),
   ('kev', 'cisa_kev_2024-01-21.json', 'missing or non-list ' || chr(39) || 'vulnerabilities' || chr(39)),
   ('epss', 'epss_2024-01-21.csv', 'header lacks cve, epss or percentile')) AS t(kind, source_file, reason)""",
        "build_history": with_(*S12, metrics_block(1), metrics_block(2)) + " SELECT * FROM metrics1 UNION ALL SELECT * FROM metrics2",
        "build_changes": with_(*S12) + f" SELECT _change_type, count(*) AS rows FROM ({_diff()}) GROUP BY 1",
        "catalog_tables": with_(*G) + f"""
 SELECT 'silver' AS schema, 'cve_core' AS "table", 'Core CVE metadata from NVD; latest record per CVE' AS comment, 'silver' AS quality, (SELECT count(*) FROM core2) AS rows
 UNION ALL SELECT 'silver', 'cve_signals', 'EPSS scores and KEV status per CVE', 'silver', (SELECT count(*) FROM signals2)
 UNION ALL SELECT 'silver', 'cve_affected_products', 'Vulnerable vendor/product/version per CVE from CPE configurations', 'silver', (SELECT count(*) FROM products2)
 UNION ALL SELECT 'silver', 'cve_documents', 'Denormalized searchable text per CVE', 'silver', (SELECT count(*) FROM docs2)
 UNION ALL SELECT 'gold', 'vuln_enriched', 'CVE records with primary vendor/product, risk score and tier', 'gold', (SELECT count(*) FROM enriched)
 UNION ALL SELECT 'gold', 'vendor_risk_agg', 'Risk aggregate per vendor', 'gold', (SELECT count(*) FROM vra)
 UNION ALL SELECT 'gold', 'kev_recent', 'KEV additions of the last 30 days', 'gold',
   (SELECT count(*) FROM enriched WHERE kev_flag AND kev_date_added BETWEEN {AS_OF} - 30 AND {AS_OF})
 UNION ALL SELECT 'bronze', 'nvd_raw', 'NVD items as loaded', 'bronze', (SELECT 2 * count(*) FROM documents) + (SELECT count(*) FROM documents WHERE doc_id % 4 = 0)
 UNION ALL SELECT 'bronze', 'kev_raw', 'KEV entries as loaded', 'bronze', (SELECT 2 * count(*) FROM labels WHERE toxic = 1)
 UNION ALL SELECT 'bronze', 'epss_raw', 'EPSS rows as loaded', 'bronze', (SELECT 2 * count(*) FROM documents WHERE doc_id % 10 <> 9)
   + (SELECT count(*) FROM documents WHERE doc_id % 10 <> 9 AND doc_id % 6 = 0)""",
        "table_inspection": with_(*S2) + """
 SELECT count(*) AS rows, 'struct<cve_id:string,published:timestamp,last_modified:timestamp,description:string,cvss_v3_score:double,cvss_v3_severity:string,cvss_v3_vector:string,cvss_v2_score:double,cwe_id:string>' AS schema,
   least(count(*), 5) AS sample FROM core2""",
        "csv_export": with_(*G) + """
 SELECT cve_id, risk_score, risk_tier, kev_flag FROM enriched
 WHERE kev_flag AND cvss_v3_score >= 5.0
 ORDER BY risk_score DESC NULLS LAST, cve_id LIMIT 50""",
        "fail_rule": with_(*S2) + """
 SELECT 'cve_core' AS "table", 'id_present' AS rule, bool_or(cve_id IS NULL) AS stopped FROM core2
 UNION ALL SELECT 'cve_core', 'id_upper_case', bool_or(NOT starts_with(cve_id, 'CVE-')) FROM core2
 UNION ALL SELECT 'cve_signals', 'id_present', bool_or(cve_id IS NULL) FROM signals2
 UNION ALL SELECT 'cve_signals', 'id_upper_case', bool_or(NOT starts_with(cve_id, 'CVE-')) FROM signals2""",
        "stream_dedup_events": """
 SELECT DISTINCT user_id, event_id, ts, event_type, value FROM events""",
        "latest_event_per_user": """
 SELECT user_id, event_id, ts, event_type, value FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    }
    out["catalog_schemas"] = f"""
 WITH t AS ({out['catalog_tables']})
 SELECT s.schema, count(t.schema) AS tables, coalesce(sum(t.rows), 0)::BIGINT AS rows
 FROM (VALUES ('bronze'), ('silver'), ('gold'), ('agent')) AS s(schema) LEFT JOIN t ON t.schema = s.schema GROUP BY 1"""
    per_tool = " UNION ALL ".join(
        f"SELECT question_id, count(*) AS n FROM ({out[k]}) GROUP BY 1"
        for k in ("lookup_cve", "compare_cves", "answer_filtered", "answer_trends")
    ) + f" UNION ALL SELECT query_id AS question_id, count(*) AS n FROM ({out['answer_semantic']}) GROUP BY 1"
    out["answer_questions"] = with_(*Q) + f"""
 SELECT p.question_id, p.intent,
   CASE p.intent WHEN 'CVE_LOOKUP' THEN 'cve_lookup' WHEN 'COMPARISON' THEN 'comparison'
     WHEN 'FILTERED_SEARCH' THEN 'sql_query' WHEN 'TREND_ANALYSIS' THEN 'sql_query'
     WHEN 'SEMANTIC_SEARCH' THEN 'vector_search' END AS tool,
   coalesce(c.n, 0) AS results
 FROM parsed p LEFT JOIN ({per_tool}) c ON p.question_id = c.question_id"""
    return out
