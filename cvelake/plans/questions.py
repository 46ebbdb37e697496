"""Question routing and the answer tools, as batch jobs over a question table.

Input: a DataFrame ``(question_id, raw_query)``. Routing is rule-based and
deterministic; each tool is a keyed join against the Gold tables:

* lookup / compare / not-found: equi-join on ``cve_id``;
* filtered search: rows are cut to the best few of each (vendor, tier, KEV flag,
  day) cell, questions are reduced to their distinct filter sets, and sets meet
  cells on their vendors, else on their tiers;
* trends: KEV rows are cut to the newest few per (vendor, tier) key, or counted by
  vendor, tier and day, and the distinct filter sets join those on their keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvelake.functions import text as tx
from cvelake.functions.columns import TIERS, truncate_text
from cvelake.plans.gold import as_of_date, recent_kev_filter
from cvelake.session import stage

RESULT_COLUMNS = ["cve_id", "description", "risk_score", "risk_tier", "kev_flag"]
SUMMARY_CHARS = 300  # description length shown in a lookup summary


# ------------------------------------------------------------------ routing

def classify_questions(questions: DataFrame, vendors: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Parsed questions: intent, cve_ids, risk_tiers, kev_only, vendors,
    date_from, search_text (plus question_id, raw_query).

    ``vendors`` is a one-column DataFrame of known vendor names (e.g. the
    distinct vendors of the affected-products table); its names are matched with
    the word runs of the questions by an equi-join, never collected to the driver.
    """
    d = as_of_date(as_of)
    raw = F.coalesce(F.col("raw_query"), F.lit(""))
    parsed = questions.select(
        "question_id", "raw_query",
        tx.tokens(raw).alias("_tok"),
        tx.cve_ids(raw).alias("cve_ids"),
    ).withColumn("_pad", tx.padded(F.col("_tok")))

    # A vendor is found where its words stand in the question, however they are
    # joined: question word runs, up to the longest vendor, equi-join vendor names.
    known = (
        vendors.select(F.lower(F.col(vendors.columns[0])).alias("vendor")).distinct()
        .withColumn("run", tx.word_key(F.col("vendor"))).filter(F.col("run") != "")
    )
    longest = known.agg(F.max(F.size(F.split("run", " ")))).scalar()
    # The words are split once, and the runs are slices of that column. Most words
    # begin no vendor's name: a question's distinct words are dealt to the join with those
    # that do, and only the runs that begin with one of them are dealt to the join on runs.
    split = questions.select("question_id", tx.words(raw).alias("_words"), F.coalesce(longest, F.lit(1)).alias("_longest"))
    first = lambda: F.substring_index("run", " ", 1)
    begins = known.select(first().alias("_first")).distinct()
    firsts = (
        split.select("question_id", F.explode(F.array_distinct("_words")).alias("_first"))
        .join(begins, "_first", "left_semi")
        .groupBy("question_id").agg(F.collect_set("_first").alias("_firsts"))
    )
    runs = split.join(firsts, "question_id").select("question_id", "_firsts", F.explode(tx.word_runs(F.col("_words"), F.col("_longest"))).alias("run"))
    hits = (
        runs.filter(F.array_contains("_firsts", first())).drop("_firsts")
        .join(known, "run")
        .groupBy("question_id")
        .agg(F.array_sort(F.collect_set("vendor")).alias("vendors"))
    )
    p = parsed.join(hits, "question_id", "left").withColumn(
        "vendors", F.coalesce(F.col("vendors"), F.array().cast("array<string>"))
    )

    tok, pad = F.col("_tok"), F.col("_pad")
    n_ids = F.size("cve_ids")
    compare = tx.has_any_word(tok, tx.COMPARISON_WORDS)
    trend = tx.has_any_word(tok, tx.TREND_WORDS) | tx.has_any_phrase(pad, tx.TREND_PHRASES)
    kev = tx.has_any_word(tok, tx.KEV_WORDS) | tx.has_any_phrase(pad, tx.KEV_PHRASES)
    tiers = F.array_sort(F.transform(
        F.array_intersect(F.array(*[F.lit(t) for t in tx.TIER_WORDS]), tok), lambda t: F.upper(t)
    ))
    filt = (F.size(tiers) > 0) | kev | (F.size("vendors") > 0)
    blank = F.size(tok) == 0
    intent = (
        F.when(blank & (n_ids == 0), "UNKNOWN")
        .when(n_ids == 1, "CVE_LOOKUP")
        .when((n_ids > 1) | compare, "COMPARISON")
        .when(trend, "TREND_ANALYSIS")
        .when(filt, "FILTERED_SEARCH")
        .otherwise("SEMANTIC_SEARCH")
    )
    days = tx.last_n_days(pad)
    date_from = F.coalesce(
        tx.since_date(raw),
        F.when(days.isNotNull(), tx.days_before(d, days)),
        F.when(pad.contains(" this week "), F.date_sub(d, 7)),
        F.when(pad.contains(" this month "), F.date_sub(d, 30)),
    )
    return p.select(
        "question_id", "raw_query",
        intent.alias("intent"),
        "cve_ids",
        tiers.alias("risk_tiers"),
        kev.alias("kev_only"),
        "vendors",
        date_from.alias("date_from"),
        F.when(intent == "SEMANTIC_SEARCH", F.trim(raw)).alias("search_text"),
    )


# ------------------------------------------------------------------ lookups

def product_arrays(products: DataFrame) -> DataFrame:
    return products.groupBy("cve_id").agg(
        F.array_sort(F.collect_set("vendor")).alias("vendors"),
        F.array_sort(F.collect_set("product")).alias("products"),
    )


def lookup_cves(ids: DataFrame, enriched: DataFrame, products: DataFrame) -> DataFrame:
    """For each requested ``cve_id`` (with any extra key columns of ``ids``):
    the enriched record plus all affected vendors and products. Unknown ids
    give no row (see :func:`not_found`)."""
    rec = enriched.select(
        "cve_id", "description", "cvss_v3_score", "epss_score", "kev_flag", "risk_score", "risk_tier",
        "published", "cwe_id", truncate_text(F.col("description"), SUMMARY_CHARS).alias("description_short"),
    )
    # Only the products of the requested ids are collected.
    asked = products.join(ids.select("cve_id").distinct(), "cve_id", "left_semi")
    return ids.join(rec, "cve_id").join(product_arrays(asked), "cve_id", "left")


def question_ids(parsed: DataFrame, intents=("CVE_LOOKUP", "COMPARISON")) -> DataFrame:
    return parsed.filter(F.col("intent").isin(*intents)).select(
        "question_id", F.explode("cve_ids").alias("cve_id")
    )


def not_found(ids: DataFrame, enriched: DataFrame) -> DataFrame:
    """Requested ids absent from the enriched table, with a format check."""
    from cvelake.functions.columns import CVE_ID_PATTERN

    return ids.join(enriched.select("cve_id"), "cve_id", "left_anti").withColumn(
        "valid_format", F.col("cve_id").rlike(CVE_ID_PATTERN)
    )


def rationale(c_kev: Column, c_ransom: Column, c_epss: Column, c_cvss: Column) -> Column:
    """Why a CVE ranks where it does: KEV, ransomware, EPSS, CVSS, in that order."""
    return F.concat_ws(
        "; ",
        F.when(c_kev, F.lit("actively exploited (KEV)")),
        F.when(c_ransom == "Known", F.lit("known ransomware use")),
        F.when(c_epss.isNotNull(), F.concat(F.lit("EPSS "), F.round(c_epss * 100, 1).cast("string"), F.lit("%"))),
        F.when(c_cvss.isNotNull(), F.concat(F.lit("CVSS "), F.round(c_cvss, 1).cast("string"))),
    )


def compare_cves(ids: DataFrame, enriched: DataFrame, group: str = "question_id") -> DataFrame:
    """Rank the ids of each group by risk_score (desc), cve_id; explain each
    rank and name the one to prioritise."""
    j = ids.join(enriched, "cve_id")
    w = Window.partitionBy(group).orderBy(F.col("risk_score").desc_nulls_last(), F.col("cve_id"))
    r = j.withColumn("rank", F.row_number().over(w)).withColumn(
        "rationale", rationale(F.col("kev_flag"), F.col("kev_ransomware_use"), F.col("epss_score"), F.col("cvss_v3_score"))
    )
    rec = F.when(
        F.col("rank") == 1,
        F.concat(F.lit("Prioritize "), F.col("cve_id"), F.lit(" because "),
                 F.when(F.col("rationale") == "", F.lit("it has the highest risk score")).otherwise(F.col("rationale"))),
    )
    return r.select(group, "rank", "cve_id", "risk_score", "risk_tier", "rationale", rec.alias("recommendation"))


# ------------------------------------------------------------------ filtered search

@dataclass(frozen=True)
class QueryFilters:
    vendors: tuple[str, ...] = ()
    products: tuple[str, ...] = ()
    risk_tiers: tuple[str, ...] = ()
    kev_only: bool = False
    min_cvss: float | None = None
    min_epss: float | None = None
    date_from: str | None = None
    date_to: str | None = None
    limit: int = 20


def filter_predicate(f: QueryFilters) -> Column:
    """Conjunction of the set filters over enriched columns (vendor/product
    membership is a semi-join, see :func:`filtered_search`)."""
    c = F.lit(True)
    if f.risk_tiers:
        c = c & F.col("risk_tier").isin(*[t.upper() for t in f.risk_tiers])
    if f.kev_only:
        c = c & F.col("kev_flag")
    if f.min_cvss is not None:
        c = c & (F.col("cvss_v3_score") >= F.lit(float(f.min_cvss)))
    if f.min_epss is not None:
        c = c & (F.col("epss_score") >= F.lit(float(f.min_epss)))
    if f.date_from is not None:
        c = c & (F.col("published") >= F.lit(f.date_from).cast("date").cast("timestamp"))
    if f.date_to is not None:
        c = c & (F.col("published") < F.date_add(F.lit(f.date_to).cast("date"), 1).cast("timestamp"))
    return c


def filtered_search(enriched: DataFrame, products: DataFrame, f: QueryFilters) -> DataFrame:
    """Rows of ``enriched`` meeting every filter, best ``limit`` by risk."""
    e = enriched.filter(filter_predicate(f))
    if f.vendors or f.products:
        m = products
        if f.vendors:
            m = m.filter(F.lower("vendor").isin(*[v.lower() for v in f.vendors]))
        if f.products:
            m = m.filter(F.lower("product").isin(*[p.lower() for p in f.products]))
        e = e.join(m.select("cve_id"), "cve_id", "left_semi")
    return e.orderBy(F.col("risk_score").desc_nulls_last(), F.col("cve_id")).limit(f.limit).select(*RESULT_COLUMNS)


def answer_filtered(parsed: DataFrame, enriched: DataFrame, products: DataFrame, limit: int) -> DataFrame:
    """Best ``limit`` CVEs for every FILTERED_SEARCH question, ranked.

    Exact pre-reduction: a filter set passes or fails all rows of one (vendor, tier,
    KEV flag, published day) cell alike, so only a cell's best ``limit`` rows can be
    in an answer. Questions are reduced to their distinct filter sets, sets meet
    cells (never all rows of a tier) on their key, and each set takes its best rows.
    """
    set_cols = ["vendors", "risk_tiers", "kev_only", "date_from"]
    q = parsed.filter(F.col("intent") == "FILTERED_SEARCH").select("question_id", *set_cols)
    # The one nullable filter gets a value, so that sets join on their columns.
    q = q.withColumn("date_from", F.coalesce("date_from", F.lit("0001-01-01").cast("date")))
    sets = q.select(*set_cols).distinct()
    no_date = F.col("date_from") == F.lit("0001-01-01").cast("date")

    # Texts don't take part: they are joined to the hits at the end.
    shown = [c for c in RESULT_COLUMNS if c != "description"]
    e = enriched.select(*shown, "published").withColumn("day", F.to_date("published")).drop("published")
    best = [F.col("risk_score").desc_nulls_last(), F.col("cve_id")]

    def cells(rows: DataFrame, *key: str) -> DataFrame:
        # Spark limits each cell map-side before the window's shuffle.
        w = Window.partitionBy(*key, "risk_tier", "kev_flag", "day").orderBy(*best)
        return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= limit).drop("place")

    pairs = products.filter(F.col("vendor").isNotNull()).select("cve_id", F.lower("vendor").alias("key")).distinct()
    by_vendor = cells(e.join(pairs, "cve_id"), "key")
    plain = cells(e)
    by_tier = plain.withColumn("key", F.col("risk_tier"))

    keyed_vendor = sets.filter(F.size("vendors") > 0).withColumn("key", F.explode("vendors"))
    every_tier = F.array(*[F.lit(t) for t in (*(name for _, name in TIERS), "LOW")])
    keyed_tier = sets.filter(F.size("vendors") == 0).withColumn(
        "key", F.explode(F.when(F.size("risk_tiers") > 0, F.col("risk_tiers")).otherwise(every_tier)))
    cols = [*set_cols, *shown, "day"]
    met = (
        keyed_vendor.join(by_vendor, "key").select(*cols)
        .unionByName(keyed_tier.join(by_tier, "key").select(*cols))
    )
    ok = (
        ((F.size("risk_tiers") == 0) | F.array_contains("risk_tiers", F.col("risk_tier")))
        & (~F.col("kev_only") | F.col("kev_flag"))
        & (no_date | (F.col("day") >= F.col("date_from")))
    )
    # A CVE may match several vendors of one set: keep it once.
    met = met.filter(ok).dropDuplicates([*set_cols, "cve_id"])
    w = Window.partitionBy(*set_cols).orderBy(*best)
    top = stage(met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).drop("day"), "filtered-hits")
    hit = top.select(F.col("cve_id").alias("_hit")).distinct()
    texts = enriched.join(hit, F.col("cve_id").eqNullSafe(F.col("_hit")), "left_semi").groupBy(F.col("cve_id").alias("_of"))
    texts = texts.agg(F.first("description").alias("description"))
    top = top.join(texts, F.col("cve_id").eqNullSafe(F.col("_of")), "left")
    return q.join(top, set_cols).select("question_id", "rank", *RESULT_COLUMNS)


# ------------------------------------------------------------------ trends

ANY = "*"  # stands for "no filter" in the trend keys


def _trend_sets(parsed: DataFrame, as_of: str | Column | None, days: int) -> tuple[DataFrame, DataFrame]:
    """(questions with their start date and filters, the distinct filter sets)."""
    q = parsed.filter(F.col("intent") == "TREND_ANALYSIS").select(
        "question_id", F.coalesce(F.col("date_from"), F.date_sub(as_of_date(as_of), days)).alias("since"), "vendors", "risk_tiers"
    )
    return q, q.select("since", "vendors", "risk_tiers").distinct()


def _any_or(values: str) -> Column:
    return F.explode(F.when(F.size(values) > 0, F.col(values)).otherwise(F.array(F.lit(ANY))))


def _kev_rows(enriched: DataFrame, as_of: str | Column | None) -> DataFrame:
    return enriched.filter(F.col("kev_flag") & (F.col("kev_date_added") <= as_of_date(as_of))).select(
        "cve_id", "kev_date_added", "risk_score", "risk_tier"
    )


def answer_trends(parsed: DataFrame, enriched: DataFrame, products: DataFrame, limit: int,
                  as_of: str | Column | None = None, days: int = 30) -> DataFrame:
    """Per TREND_ANALYSIS question: the newest ``limit`` KEV additions since its
    date (its parsed date phrase, else the last ``days`` days) that meet its vendor
    and tier filters.

    Exact pre-reduction: KEV rows are filed under (vendor or any, tier or any) and
    only the newest ``limit`` of each key are kept, since a start date merely cuts
    such a list short. A question's list is the merge of its keys' lists.
    """
    q, sets = _trend_sets(parsed, as_of, days)
    kev = _kev_rows(enriched, as_of)
    vendors = products.filter(F.col("vendor").isNotNull()).select("cve_id", F.lower("vendor").alias("vendor_key")).distinct()
    by_vendor = kev.join(vendors, "cve_id").unionByName(kev.withColumn("vendor_key", F.lit(ANY)))
    filed = by_vendor.withColumn("tier_key", F.explode(F.array(F.col("risk_tier"), F.lit(ANY))))
    # Spark limits each key map-side before the window's shuffle.
    newest = Window.partitionBy("vendor_key", "tier_key").orderBy(F.col("kev_date_added").desc(), F.col("cve_id"))
    lists = filed.withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= limit).drop("place")
    set_cols = ["since", "vendors", "risk_tiers"]
    keyed = sets.select(*set_cols, _any_or("vendors").alias("vendor_key")).select("*", _any_or("risk_tiers").alias("tier_key"))
    found = (
        keyed.join(lists, ["vendor_key", "tier_key"])
        .filter(F.col("kev_date_added") >= F.col("since"))
        .dropDuplicates([*set_cols, "cve_id"])
    )
    w = Window.partitionBy(*set_cols).orderBy(F.col("kev_date_added").desc(), F.col("cve_id"))
    top = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    return q.join(top, set_cols).select("question_id", "rank", "cve_id", "kev_date_added", "risk_score", "risk_tier")


def answer_trend_vendors(parsed: DataFrame, enriched: DataFrame, products: DataFrame, limit: int,
                         as_of: str | Column | None = None, days: int = 30) -> DataFrame:
    """Per TREND_ANALYSIS question: the ``limit`` vendors with most KEV additions
    since its date in its tiers; only its own vendors, if it names any.

    KEV rows are first counted by vendor, tier and day, so filter sets meet
    counts, never rows."""
    q, sets = _trend_sets(parsed, as_of, days)
    pairs = products.filter(F.col("vendor").isNotNull()).select("cve_id", F.lower("vendor").alias("vendor")).distinct()
    daily = (
        _kev_rows(enriched, as_of).join(pairs, "cve_id")
        .groupBy("vendor", "risk_tier", "kev_date_added").agg(F.count(F.lit(1)).alias("n"))
    )
    filed = daily.withColumn("vendor_key", F.explode(F.array(F.col("vendor"), F.lit(ANY)))).withColumn(
        "tier_key", F.explode(F.array(F.col("risk_tier"), F.lit(ANY))))
    set_cols = ["since", "vendors", "risk_tiers"]
    keyed = sets.select(*set_cols, _any_or("vendors").alias("vendor_key")).select("*", _any_or("risk_tiers").alias("tier_key"))
    counts = (
        keyed.join(filed, ["vendor_key", "tier_key"])
        .filter(F.col("kev_date_added") >= F.col("since"))
        .groupBy(*set_cols, "vendor").agg(F.sum("n").alias("kev_count"))
    )
    w = Window.partitionBy(*set_cols).orderBy(F.col("kev_count").desc(), F.col("vendor"))
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    return q.join(top, set_cols).select("question_id", "rank", "vendor", "kev_count")


def trend_vendors(enriched: DataFrame, products: DataFrame, as_of: str | Column | None = None, days: int = 30) -> DataFrame:
    """Vendors of the KEV entries added in the last ``days`` days, by count."""
    recent = enriched.filter(recent_kev_filter(days, as_of)).select("cve_id")
    pairs = products.filter(F.col("vendor").isNotNull()).select("cve_id", "vendor").distinct()
    return (
        pairs.join(recent, "cve_id", "left_semi")
        .groupBy("vendor")
        .agg(F.count(F.lit(1)).alias("recent_kev_count"))
        .orderBy(F.col("recent_kev_count").desc(), F.col("vendor"))
    )


# ------------------------------------------------------------------ orchestration

# The tool that serves each intent.
TOOLS = {
    "CVE_LOOKUP": "cve_lookup",
    "COMPARISON": "comparison",
    "FILTERED_SEARCH": "sql_query",
    "TREND_ANALYSIS": "sql_query",
    "SEMANTIC_SEARCH": "vector_search",
}


def answer_questions(parsed: DataFrame, enriched: DataFrame, products: DataFrame, semantic_hits: DataFrame,
                     filtered_limit: int, trend_limit: int, as_of: str | Column | None = None) -> DataFrame:
    """Per question: intent, the tool that answered it and how many result
    rows it returned (0 when nothing matched; UNKNOWN gets no tool).

    ``semantic_hits`` holds (query_id, ...) rows of the semantic search run
    over the SEMANTIC_SEARCH questions.
    """
    def counts(df: DataFrame, key: str = "question_id") -> DataFrame:
        return df.groupBy(F.col(key).alias("question_id")).agg(F.count(F.lit(1)).alias("n"))

    per_tool = (
        counts(lookup_cves(question_ids(parsed, ["CVE_LOOKUP"]), enriched, products))
        .unionByName(counts(question_ids(parsed, ["COMPARISON"]).join(enriched.select("cve_id"), "cve_id")))
        .unionByName(counts(answer_filtered(parsed, enriched, products, filtered_limit)))
        .unionByName(counts(answer_trends(parsed, enriched, products, trend_limit, as_of)))
        .unionByName(counts(semantic_hits, "query_id"))
    )
    tool = F.lit(None).cast("string")
    for intent, name in TOOLS.items():
        tool = F.when(F.col("intent") == intent, F.lit(name)).otherwise(tool)
    return parsed.select("question_id", "intent").join(per_tool, "question_id", "left").select(
        "question_id", "intent", tool.alias("tool"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("results"),
    )
