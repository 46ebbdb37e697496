"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables under ``sf_dir`` (through the fixture
adapter) and runs the full Bronze -> Silver (-> Gold) chain it needs, so
its work grows with the tables. Array results are rendered as joined
strings so they compare across engines.
"""

from __future__ import annotations

import gzip
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.operators import quality as q
from cvelake.operators.changes import snapshot_diff
from cvelake.operators.dedup import bronze_recency, latest_per_key
from cvelake.plans import dashboard as dash
from cvelake.plans import gold as gd
from cvelake.plans import questions as qs
from cvelake.plans import quality_report as qr
from cvelake.plans import search as se
from cvelake.plans import silver as sv
from cvelake.schemas import AFFECTED_PRODUCTS_COLUMNS, BRONZE_JSON, CVE_CORE_COLUMNS
from cvelake.session import prepare, scratch_dir, stage
from cvelake.streaming import incremental as inc
from cvelake.sources import feeds
from cvelake.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
RUNS = (fx.RUN_1, fx.RUN_2)
FILTERED_ROWS, TREND_ROWS, TREND_VENDORS = 20, 20, 5  # rows of one answer: top-k reports


def _bronze(spark: SparkSession, sf_dir: str, run_ts: str | None = None):
    prepare(spark)
    b = fx.bronze_nvd(spark, sf_dir), fx.bronze_epss(spark, sf_dir), fx.bronze_kev(spark, sf_dir)
    return b if run_ts is None else tuple(qr.as_of_run(x, run_ts) for x in b)


def parsed_nvd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All NVD Bronze rows, parsed once and written: every branch and every version
    of a query reads the columns it needs instead of the payload."""
    prepare(spark)
    return stage(sv.parse_nvd(fx.bronze_nvd(spark, sf_dir)), "nvd-parsed")


def silver(spark: SparkSession, sf_dir: str, run_ts: str | None = None, staged: bool = False,
           parsed: DataFrame | None = None) -> sv.Silver:
    """The Silver tables after the run at ``run_ts`` (all runs if not given). With
    ``staged`` the affected products, which several later steps read, are written."""
    nvd, epss, kev = _bronze(spark, sf_dir, run_ts)
    parsed = parsed_nvd(spark, sf_dir) if parsed is None else parsed
    if run_ts is not None:
        parsed = qr.as_of_run(parsed, run_ts)
    core = sv.cve_core(nvd, parsed)
    signals = sv.cve_signals(epss, kev)
    products = sv.cve_affected_products(nvd, parsed)
    if staged:
        products = stage(products, "cve_affected_products")
    return sv.Silver(core, signals, products, sv.cve_documents(core, signals, products))


def enriched(spark: SparkSession, sf_dir: str, staged: bool = False):
    """Silver + vuln_enriched. Queries that read the Gold table several times
    pass ``staged`` so it is written once (as the Gold table is) and re-read."""
    s = silver(spark, sf_dir, staged=staged)
    e = gd.vuln_enriched(s.core, s.signals, s.products)
    return s, (stage(e, "vuln_enriched") if staged else e)


# ------------------------------------------------------------------ Silver

def q_cve_core_latest(spark, sf_dir):
    prepare(spark)
    return sv.cve_core(fx.bronze_nvd(spark, sf_dir))


def q_cve_signals(spark, sf_dir):
    prepare(spark)
    return sv.cve_signals(fx.bronze_epss(spark, sf_dir), fx.bronze_kev(spark, sf_dir))


def q_affected_products(spark, sf_dir):
    prepare(spark)
    return sv.cve_affected_products(fx.bronze_nvd(spark, sf_dir))


def q_cve_documents(spark, sf_dir):
    return silver(spark, sf_dir).documents


def q_as_of_core(spark, sf_dir):
    """cve_core as it stood after run 1 (time travel on append-only Bronze)."""
    nvd, _, _ = _bronze(spark, sf_dir, fx.RUN_1)
    return sv.cve_core(nvd)


def q_snapshot_diff(spark, sf_dir):
    """Change feed of cve_documents between run 1 and run 2."""
    parsed = parsed_nvd(spark, sf_dir)
    old, new = silver(spark, sf_dir, fx.RUN_1, parsed=parsed), silver(spark, sf_dir, parsed=parsed)
    return snapshot_diff(old.documents, new.documents, ["cve_id"])


# ------------------------------------------------------------------ feed files

def feed_files(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ("nvd", "kev", "epss")) -> str:
    """Write the fixture snapshots of ``kinds`` as feed files under the shared scratch folder."""
    prepare(spark)
    root = scratch_dir(spark, "feeds")
    if "nvd" in kinds:
        feeds.write_nvd_files(fx.nvd_items(spark, sf_dir), f"{root}/nvd")
    if "kev" in kinds:
        feeds.write_kev_files(fx.kev_entries(spark, sf_dir), f"{root}/kev", fx.SNAP_1)
    if "epss" in kinds:
        feeds.write_epss_files(fx.epss_rows(spark, sf_dir), f"{root}/epss")
    return root


def _read_feeds(spark, root: str, run_ts: str = fx.RUN_2):
    return (feeds.read_nvd(spark, f"{root}/nvd", run_ts),
            feeds.read_kev(spark, f"{root}/kev", run_ts),
            feeds.read_epss(spark, f"{root}/epss", run_ts))


# Files that an ingest must skip or read with care, next to the fixture's own.
ODD_FILES = {
    "nvd/nvd_modified_2024-01-20.json.gz": b"this is not gzip",
    "nvd/nvd_undated.json.gz": gzip.compress(b'{"CVE_data_numberOfCVEs":1,"CVE_Items":[{"cve":{"id":"CVE-1999-0001"}}]}', mtime=0),
    "kev/cisa_kev_2024-01-20.json": b'{"vulnerabilities": [{"cveID": ',
    "kev/cisa_kev_2024-01-21.json": b'{"entries": []}',
    "epss/epss_2024-01-20.csv": b"#model:v1\npercentile,epss,cve\n0.25,0.5,CVE-1999-0001\n",
    "epss/epss_2024-01-21.csv": b"id,score\nfoo,bar\n",
    "epss/deeper/epss_2024-01-22.csv": b"cve,epss,percentile\nCVE-1999-0002,0.1,0.1\n",
}


def _odd_feeds(spark, sf_dir) -> str:
    root = feed_files(spark, sf_dir)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name, content in ODD_FILES.items():
        at = path(f"{root}/{name}")
        out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
        out.write(bytearray(content))
        out.close()
    return root


def q_ingest_odd_files(spark, sf_dir):
    """Bronze rows per source and snapshot date, from a folder that also holds
    corrupt, malformed, undated and reordered files."""
    return feeds.ingest_summary(*_read_feeds(spark, _odd_feeds(spark, sf_dir)))


def q_ingest_report(spark, sf_dir):
    """The files that an ingest skipped, and why, as it noted them itself."""
    from cvelake.plans import build

    root = _odd_feeds(spark, sf_dir)
    build.ingest(spark, f"{root}/tables", root, fx.RUN_2)
    return build.skipped_files(spark, f"{root}/tables")


def q_bronze_ingest(spark, sf_dir):
    nvd, kev, epss = _read_feeds(spark, feed_files(spark, sf_dir))
    return feeds.ingest_summary(nvd, kev, epss)


def q_core_from_files(spark, sf_dir):
    """cve_core from feed files loaded in one run (both snapshots share the
    run's ingest_ts; the newer snapshot date wins)."""
    root = feed_files(spark, sf_dir, ("nvd",))
    return sv.cve_core(feeds.read_nvd(spark, f"{root}/nvd", fx.RUN_2))


def q_signals_from_files(spark, sf_dir):
    root = feed_files(spark, sf_dir, ("kev", "epss"))
    return sv.cve_signals(feeds.read_epss(spark, f"{root}/epss", fx.RUN_2), feeds.read_kev(spark, f"{root}/kev", fx.RUN_2))


def q_build_job(spark, sf_dir):
    """The production batch job end to end: feed files -> Bronze append ->
    Silver and Gold written per run -> the written vendor_risk_agg table."""
    from cvelake.plans import build

    root = feed_files(spark, sf_dir)
    tables = f"{root}/tables"
    build.ingest(spark, tables, root, fx.RUN_2).count()
    build.build_run(spark, tables, "r2", fx.RUN_2, fx.AS_OF, buckets=8)
    return spark.read.parquet(f"{tables}/gold/run=r2/vendor_risk_agg")


def q_file_validation(spark, sf_dir):
    root = feed_files(spark, sf_dir)
    v = (feeds.validate_files(spark, f"{root}/nvd", "nvd")
         .unionByName(feeds.validate_files(spark, f"{root}/kev", "kev"))
         .unionByName(feeds.validate_files(spark, f"{root}/epss", "epss")))
    return v.groupBy("kind").agg(
        F.bool_and("ok").alias("all_ok"),
        F.bool_and("count_matches").alias("counts_match"),
        F.sum("n_records").alias("n_records"),
    )


def _two_runs(spark, sf_dir) -> str:
    """Two production runs over growing Bronze: the state after snapshot 1, then
    both snapshots. Returns the root of the written tables."""
    from cvelake.plans import build

    prepare(spark)
    root = scratch_dir(spark, "two-runs")
    nvd, epss, kev = _bronze(spark, sf_dir)
    for n, run in enumerate(RUNS, 1):
        for name, df in (("nvd_raw", nvd), ("kev_raw", kev), ("epss_raw", epss)):
            df.filter(F.col("ingest_ts") == F.lit(run).cast("timestamp")).write.mode("append").parquet(f"{root}/bronze/{name}")
        build.build_run(spark, root, f"r{n}", run, fx.AS_OF, previous_run_id=f"r{n - 1}" if n > 1 else None)
    return root


def q_build_history(spark, sf_dir):
    """Expectation metrics that two runs appended, newest run first."""
    from cvelake.plans import build

    return build.quality_history(spark, _two_runs(spark, sf_dir)).drop("run")


def q_build_changes(spark, sf_dir):
    """The change feed that the second run wrote, counted by kind of change."""
    root = _two_runs(spark, sf_dir)
    return spark.read.parquet(f"{root}/silver/cve_documents_changes").groupBy("_change_type").agg(F.count(F.lit(1)).alias("rows"))


def q_catalog_tables(spark, sf_dir):
    """A run's tables in the catalog: schema, table, comment, quality property, rows."""
    from cvelake.plans import build

    root = _two_runs(spark, sf_dir)
    build.create_schemas(spark)
    rows = []
    for name in build.register_run(spark, root, "r2"):  # the fixed list of tables
        schema, table = name.split(".")
        info = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        quality = spark.sql(f"SHOW TBLPROPERTIES {name} ('quality')").first()["value"]
        rows.append((schema, table, info.get("Comment"), quality, spark.table(name).count()))
    return spark.createDataFrame(rows, "schema string, table string, comment string, quality string, rows long")


def q_catalog_schemas(spark, sf_dir):
    """The catalog's schemas after a run, with their tables and rows."""
    from cvelake.plans import build

    tables = q_catalog_tables(spark, sf_dir).groupBy("schema").agg(F.count("*").alias("tables"), F.sum("rows").alias("rows"))
    listed = build.list_schemas(spark).join(tables, "schema", "left")
    return listed.select("schema", F.coalesce("tables", F.lit(0)).cast("long").alias("tables"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def q_table_inspection(spark, sf_dir):
    """Row count, schema and sample size of the core table."""
    from cvelake.plans import build

    rows, schema, sample = build.inspect(stage(q_cve_core_latest(spark, sf_dir), "inspected"))
    return spark.createDataFrame([(rows, schema, sample.count())], "rows long, schema string, sample long")


def q_csv_export(spark, sf_dir):
    """The priority list, written as CSV with a header and read back."""
    from cvelake.plans import build

    path = scratch_dir(spark, "csv")
    build.export_csv(q_priority_list(spark, sf_dir).select("cve_id", "risk_score", "risk_tier", "kev_flag"), path)
    return spark.read.option("header", True).schema("cve_id string, risk_score double, risk_tier string, kev_flag boolean").csv(path)


def q_fail_rule(spark, sf_dir):
    """Which tables a ``fail`` rule on the id format would stop before they are written."""
    s = silver(spark, sf_dir)
    rows = []
    for name, df in (("cve_core", s.core), ("cve_signals", s.signals)):
        for rule in (q.Expectation("id_present", "cve_id IS NOT NULL", "fail"),
                     q.Expectation("id_upper_case", "cve_id RLIKE '^CVE-'", "fail")):
            try:
                q.enforce(q.expectation_metrics(df, [rule], name, fx.RUN_2))
                rows.append((name, rule.name, False))
            except q.ExpectationFailed:
                rows.append((name, rule.name, True))
    return spark.createDataFrame(rows, "table string, rule string, stopped boolean")


# ------------------------------------------------------------------ quality

def q_dq_metrics(spark, sf_dir):
    return sv.silver_metrics(*_bronze(spark, sf_dir), fx.RUN_2, staged=True)


def q_dq_severity(spark, sf_dir):
    return q.warn_severity(q_dq_metrics(spark, sf_dir))


def q_dq_trend(spark, sf_dir):
    return q.failure_trend(qr.metrics_history(*_bronze(spark, sf_dir), RUNS, staged=True))


def q_dq_escalation(spark, sf_dir):
    return qr.escalation_report(*_bronze(spark, sf_dir), RUNS)


def q_dq_by_snapshot(spark, sf_dir):
    prepare(spark)
    return qr.snapshot_drop_counts(fx.bronze_nvd(spark, sf_dir))


def q_malformed_ids(spark, sf_dir):
    prepare(spark)
    return qr.malformed_ids(fx.bronze_nvd(spark, sf_dir))


def q_dq_length_check(spark, sf_dir):
    s = silver(spark, sf_dir)
    return qr.short_description_count(s.core, s.signals)


def q_bronze_file_counts(spark, sf_dir):
    nvd, epss, kev = _bronze(spark, sf_dir)
    return (qr.records_per_file(nvd, "nvd").unionByName(qr.records_per_file(kev, "kev"))
            .unionByName(qr.records_per_file(epss, "epss")))


def q_distinct_vendors(spark, sf_dir):
    prepare(spark)
    p = sv.cve_affected_products(fx.bronze_nvd(spark, sf_dir))
    return p.filter(F.col("vendor").isNotNull()).select("vendor").distinct()


def q_core_by_month(spark, sf_dir):
    """cve_core written partitioned by year/month, read back per partition."""
    from cvelake.plans import build

    prepare(spark)
    path = scratch_dir(spark, "core-by-month")
    build.write_by_month(sv.cve_core(fx.bronze_nvd(spark, sf_dir)), path)
    return spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("cves"))


def doc_index(documents: DataFrame) -> DataFrame:
    """A keyed table derived from cve_documents (the part of a search index
    kept next to each embedding): recomputed only for changed keys."""
    return documents.select("cve_id", F.length("document_text").alias("text_length"), "kev_flag", "cvss_v3_score")


def q_index_sync(spark, sf_dir):
    """Index built on run 1's documents, synced with the run1 -> run2 change feed."""
    from cvelake.operators.changes import apply_changes

    # Each version is read twice (diff and index): write each once.
    parsed = parsed_nvd(spark, sf_dir)
    old = stage(silver(spark, sf_dir, fx.RUN_1, parsed=parsed).documents, "documents-run1")
    new = stage(silver(spark, sf_dir, parsed=parsed).documents, "documents-run2")
    changes = snapshot_diff(old, new, ["cve_id"])
    return apply_changes(doc_index(old), changes, ["cve_id"], doc_index(new))


def q_continuous_index_sync(spark, sf_dir):
    """The index kept by a running query: run 1's documents arrive as its first
    changes, then the changes of run 2."""
    parsed = parsed_nvd(spark, sf_dir)
    old = stage(silver(spark, sf_dir, fx.RUN_1, parsed=parsed).documents, "documents-run1")
    new = silver(spark, sf_dir, parsed=parsed).documents
    root = scratch_dir(spark, "continuous-index")
    arrivals = ((fx.RUN_1, snapshot_diff(old.limit(0), old, ["cve_id"])), (fx.RUN_2, snapshot_diff(old, new, ["cve_id"])))
    index = lambda feed: feed.select("*", F.length("document_text").alias("text_length")).select(
        "cve_id", "text_length", "kev_flag", "cvss_v3_score", "_change_type", "_commit_ts")
    running = None
    try:
        for run, changes in arrivals:
            feed = changes.withColumn("_commit_ts", F.lit(run).cast("timestamp"))
            feed.write.mode("append").parquet(f"{root}/changes")
            if running is None:
                running = inc.continuous_sync(spark, f"{root}/changes", feed.schema, index, f"{root}/index", f"{root}/ckpt",
                                              ["cve_id"], buckets=16, processing_time="1 second")
            running.processAllAvailable()
    finally:
        if running is not None:
            running.stop()
    return inc.read_index(spark, f"{root}/index", ["cve_id"])


# ------------------------------------------------------------------ Gold

def q_vuln_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)[1]


def q_vendor_risk_agg(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return gd.vendor_risk_agg(s.products, e)


def q_kev_recent(spark, sf_dir):
    return gd.kev_recent(enriched(spark, sf_dir)[1], fx.AS_OF)


def q_gold_quality(spark, sf_dir):
    return q.expectation_metrics(enriched(spark, sf_dir)[1], gd.GOLD_RULES, "vuln_enriched", fx.RUN_2)


# ------------------------------------------------------------------ questions

def _parsed(spark, sf_dir, s):
    vendors = s.products.select("vendor").filter(F.col("vendor").isNotNull())
    return qs.classify_questions(fx.questions(spark, sf_dir), vendors, fx.AS_OF)


def q_classify_questions(spark, sf_dir):
    p = _parsed(spark, sf_dir, silver(spark, sf_dir))
    return p.select(
        "question_id", "intent",
        F.array_join("cve_ids", ",").alias("cve_ids"),
        F.array_join("risk_tiers", ",").alias("risk_tiers"),
        "kev_only",
        F.array_join("vendors", ",").alias("vendors"),
        "date_from",
        F.col("search_text").isNotNull().alias("has_search_text"),
    )


def q_lookup_cve(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    ids = qs.question_ids(_parsed(spark, sf_dir, s), ["CVE_LOOKUP"])
    r = qs.lookup_cves(ids, e, s.products)
    return r.select(
        "question_id", "cve_id", "description", "cvss_v3_score", "epss_score", "kev_flag", "risk_score",
        "risk_tier", "published", "cwe_id", "description_short",
        F.array_join("vendors", " | ").alias("vendors"), F.array_join("products", " | ").alias("products"),
    )


def q_compare_cves(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    ids = qs.question_ids(_parsed(spark, sf_dir, s), ["COMPARISON"])
    return qs.compare_cves(ids, e)


def q_not_found_ids(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    return qs.not_found(qs.question_ids(_parsed(spark, sf_dir, s)), e)


FILTERS = qs.QueryFilters(vendors=("Brand_3", "brand_11"), risk_tiers=("high", "critical", "medium"), limit=25)


def q_filtered_search(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return qs.filtered_search(e, s.products, FILTERS)


ALL_FILTERS = qs.QueryFilters(
    vendors=("Brand_19", "brand_16", "brand_21", "brand_9", "brand_17", "brand_15"),
    products=("red_plate", "HOT_bolt", "small_ring", "hot_rod", "large_gear", "blue_gear", "cold_gear"),
    risk_tiers=("low", "medium", "high"), min_cvss=2.0, min_epss=0.1, date_from="2024-02-01", date_to="2024-11-15", limit=40,
)


def q_filtered_search_all(spark, sf_dir):
    """A search with all filters but the KEV flag."""
    s, e = enriched(spark, sf_dir)
    return qs.filtered_search(e, s.products, ALL_FILTERS)


def q_answer_filtered(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    return qs.answer_filtered(_parsed(spark, sf_dir, s), e, s.products, FILTERED_ROWS)


def q_answer_trends(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    return qs.answer_trends(_parsed(spark, sf_dir, s), e, s.products, TREND_ROWS, fx.AS_OF)


def q_answer_trend_vendors(spark, sf_dir):
    s, e = enriched(spark, sf_dir, staged=True)
    return qs.answer_trend_vendors(_parsed(spark, sf_dir, s), e, s.products, TREND_VENDORS, fx.AS_OF)


def q_answer_questions(spark, sf_dir):
    """Every question routed and answered: intent, tool, result count."""
    s, e = enriched(spark, sf_dir, staged=True)
    p = stage(_parsed(spark, sf_dir, s), "parsed-questions")
    sem = se.tfidf_search(s.documents, "cve_id", "document_text", p.filter(F.col("intent") == "SEMANTIC_SEARCH"),
                          "question_id", "raw_query", 5)
    return qs.answer_questions(p, e, s.products, sem, FILTERED_ROWS, TREND_ROWS, fx.AS_OF)


def q_trend_vendors(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return qs.trend_vendors(e, s.products, fx.AS_OF)


# ------------------------------------------------------------------ dashboard

def q_tier_distribution(spark, sf_dir):
    return dash.tier_distribution(enriched(spark, sf_dir)[1])


def q_data_stats(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return dash.data_stats(e, s.products)


def q_top_vendors(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return dash.top_vendors(s.products, e, 10)


PRIORITY = qs.QueryFilters(kev_only=True, min_cvss=5.0, limit=50)


def q_priority_list(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return qs.filtered_search(e, s.products, PRIORITY)


# ------------------------------------------------------------------ search

def _search_tables(spark, sf_dir):
    """(vectors, documents, enriched): Gold is written once, since a search reads it last."""
    s, e = enriched(spark, sf_dir, staged=True)
    return fx.query_vectors(spark, sf_dir), s.documents, e


def _query_vector(spark, sf_dir, vec_id: int = 0):
    row = fx.table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()
    return list(row[0])


def q_vector_topk(spark, sf_dir):
    return se.semantic_search(*_search_tables(spark, sf_dir), _query_vector(spark, sf_dir), 10)


def q_vector_topk_filtered(spark, sf_dir):
    return se.semantic_search(*_search_tables(spark, sf_dir), _query_vector(spark, sf_dir), 10, min_cvss=4.0)


def q_vector_topk_batch(spark, sf_dir):
    """Top 5 documents for every vector of the table."""
    queries = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return se.batch_search(*_search_tables(spark, sf_dir), queries, "vec_id", 5)


def q_vector_topk_indexed(spark, sf_dir):
    """The same over a cell index, with the round that makes it exact."""
    queries = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return se.indexed_search(*_search_tables(spark, sf_dir), queries, "vec_id", 5)


def q_document_vectors(spark, sf_dir):
    """The text vector of every CVE document, as its components that aren't 0."""
    vectors, _ = se.document_vectors(silver(spark, sf_dir).documents, "cve_id", "document_text")
    places = vectors.select("cve_id", F.posexplode("embedding").alias("place", "weight"))
    return places.select("cve_id", "place", F.round("weight", 6).alias("weight")).filter("weight <> 0")


def q_semantic_text_search(spark, sf_dir):
    """Top 5 CVE documents for each benchmark passage by text vectors."""
    s, e = enriched(spark, sf_dir, staged=True)
    bench = fx.table(spark, sf_dir, "benchmark")
    return se.semantic_text_search(s.documents, e, bench, "item_id", "text", 5, min_cvss=2.0)


def q_text_search_filtered(spark, sf_dir):
    """Top 5 exploited documents of CVSS 4 or more for each benchmark passage."""
    s, e = enriched(spark, sf_dir, staged=True)
    bench = fx.table(spark, sf_dir, "benchmark")
    return se.text_search(s.documents, e, bench, "item_id", "text", 5, kev_only=True, min_cvss=4.0)


def q_search_fallback(spark, sf_dir):
    """The search without vectors: keyword hits in the form of search hits."""
    s, e = enriched(spark, sf_dir, staged=True)
    return se.search_or_fallback(None, s.documents, e, None, "Weakness: CWE-1", 10, min_cvss=2.0)


def q_tfidf_search(spark, sf_dir):
    """Top 5 CVE documents for each benchmark passage (whole text)."""
    docs = silver(spark, sf_dir).documents
    bench = fx.table(spark, sf_dir, "benchmark")
    return se.tfidf_search(docs, "cve_id", "document_text", bench, "item_id", "text", 5)


def q_answer_semantic(spark, sf_dir):
    """Top 5 CVE documents for each free-text (semantic) question."""
    s = silver(spark, sf_dir)
    p = _parsed(spark, sf_dir, s).filter(F.col("intent") == "SEMANTIC_SEARCH")
    return se.tfidf_search(s.documents, "cve_id", "document_text", p, "question_id", "raw_query", 5)


def q_keyword_fallback(spark, sf_dir):
    s, e = enriched(spark, sf_dir)
    return se.keyword_search(e, s.documents, "Weakness: CWE-1", 10)


# ------------------------------------------------------------------ generic dedup on events

def q_latest_event_per_user(spark, sf_dir):
    """Latest event per user (ties on ts broken by the higher event_id)."""
    prepare(spark)
    ev = fx.table(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )


# ------------------------------------------------------------------ incremental (streaming)

EVENT_SPLIT = "2024-01-15 00:00:00"  # events land in two arrivals: before / from this time
EVENT_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value"]


def _events(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    # Watermarks need TIMESTAMP (the driver files hold TIMESTAMP_NTZ).
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def q_incremental_core(spark, sf_dir):
    """cve_core maintained by a stream over Bronze files that land run by run."""
    prepare(spark)
    root = scratch_dir(spark, "incremental-core")
    bronze = fx.bronze_nvd(spark, sf_dir)
    src, state = f"{root}/bronze_nvd", f"{root}/core_state"
    for run in RUNS:
        bronze.filter(F.col("ingest_ts") == F.lit(run).cast("timestamp")).write.mode("append").parquet(src)
        inc.run_latest_wins(
            spark, src, BRONZE_JSON, lambda df: sv.core_rows(sv.parse_nvd(df)), state, f"{root}/ckpt",
            ["cve_id"], bronze_recency, buckets=16,
        )
    return q.apply_expectations(inc.read_state(spark, state, ["cve_id"], bronze_recency).select(*CVE_CORE_COLUMNS), sv.CORE_RULES)


def q_incremental_products(spark, sf_dir):
    """cve_affected_products maintained by a stream over Bronze files that
    land run by run (state keyed by cve_id + cpe_uri)."""
    prepare(spark)
    root = scratch_dir(spark, "incremental-products")
    bronze = fx.bronze_nvd(spark, sf_dir)
    src, state = f"{root}/bronze_nvd", f"{root}/products_state"
    for run in RUNS:
        bronze.filter(F.col("ingest_ts") == F.lit(run).cast("timestamp")).write.mode("append").parquet(src)
        inc.run_latest_wins(
            spark, src, BRONZE_JSON, lambda df: sv.product_rows(sv.parse_nvd(df)), state, f"{root}/ckpt",
            ["cve_id", "cpe_uri"], bronze_recency, buckets=16,
        )
    return q.apply_expectations(inc.read_state(spark, state, ["cve_id", "cpe_uri"], bronze_recency).select(*AFFECTED_PRODUCTS_COLUMNS), sv.PRODUCTS_RULES)


def q_incremental_signals(spark, sf_dir):
    """cve_signals from two streamed latest-wins states (EPSS, KEV) joined."""
    prepare(spark)
    root = scratch_dir(spark, "incremental-signals")
    epss, kev = fx.bronze_epss(spark, sf_dir), fx.bronze_kev(spark, sf_dir)
    for run in RUNS:
        at = F.col("ingest_ts") == F.lit(run).cast("timestamp")
        epss.filter(at).write.mode("append").parquet(f"{root}/bronze_epss")
        kev.filter(at).write.mode("append").parquet(f"{root}/bronze_kev")
        inc.run_latest_wins(spark, f"{root}/bronze_epss", epss.schema, sv.epss_rows, f"{root}/epss_state",
                            f"{root}/ckpt-epss", ["cve_id"], bronze_recency, buckets=16)
        inc.run_latest_wins(spark, f"{root}/bronze_kev", kev.schema, sv.kev_rows, f"{root}/kev_state",
                            f"{root}/ckpt-kev", ["cve_id"], bronze_recency, buckets=16)
    epss_now, kev_now = (inc.read_state(spark, f"{root}/{t}_state", ["cve_id"], bronze_recency) for t in ("epss", "kev"))
    rec = sv.signals_from_latest(epss_now, kev_now)
    return q.apply_expectations(rec, sv.SIGNALS_RULES)


def q_incremental_events(spark, sf_dir):
    """Latest event per user, maintained by a stream over two arrivals."""
    prepare(spark)
    root = scratch_dir(spark, "incremental-events")
    ev = _events(spark, sf_dir)
    src, state = f"{root}/events", f"{root}/state"
    cut = F.lit(EVENT_SPLIT).cast("timestamp")
    order = lambda: [F.col("ts").desc(), F.col("event_id").desc()]
    for part in (ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut)):
        part.write.mode("append").parquet(src)
        inc.run_latest_wins(
            spark, src, ev.schema, lambda df: df, state, f"{root}/ckpt", ["user_id"],
            order, buckets=16,
        )
    return inc.read_state(spark, state, ["user_id"], order).select(*EVENT_COLUMNS)


def q_stream_ingest(spark, sf_dir):
    """Feed files of all three kinds ingested by a stream, run twice: the second
    run finds no new file, so Bronze holds every item exactly once."""
    root = feed_files(spark, sf_dir)
    found = None
    for kind in feeds.GLOBS:
        bronze = f"{root}/bronze_{kind}"
        for run in RUNS:
            inc.stream_ingest(spark, kind, f"{root}/{kind}", bronze, f"{root}/ckpt-{kind}", run)
        counts = spark.read.parquet(bronze).groupBy("snapshot_date").agg(
            F.count(F.lit(1)).alias("records"), F.count_distinct("ingest_ts").alias("runs"))
        counts = counts.select(F.lit(kind).alias("source"), "snapshot_date", "records", "runs")
        found = counts if found is None else found.unionByName(counts)
    return found


def q_stream_dedup_events(spark, sf_dir):
    """Events delivered twice (a replay) come out once: watermark dedup."""
    prepare(spark)
    root = scratch_dir(spark, "stream-dedup")
    ev = _events(spark, sf_dir)
    src, out = f"{root}/events", f"{root}/out"
    for _ in range(2):
        ev.write.mode("append").parquet(src)
    stream = inc.dedup_replayed(spark.readStream.schema(ev.schema).parquet(src), ["event_id"], "ts", "1 hour")
    qy = (stream.writeStream.format("parquet").option("path", out)
          .option("checkpointLocation", f"{root}/ckpt").outputMode("append")
          .trigger(availableNow=True).start())
    qy.awaitTermination()
    return spark.read.schema(ev.schema).parquet(out).select(*EVENT_COLUMNS)


QUERIES: dict[str, Query] = {
    "cve_core_latest": q_cve_core_latest,
    "cve_signals": q_cve_signals,
    "affected_products": q_affected_products,
    "cve_documents": q_cve_documents,
    "as_of_core": q_as_of_core,
    "bronze_ingest": q_bronze_ingest,
    "core_from_files": q_core_from_files,
    "signals_from_files": q_signals_from_files,
    "file_validation": q_file_validation,
    "build_job": q_build_job,
    "snapshot_diff": q_snapshot_diff,
    "dq_metrics": q_dq_metrics,
    "dq_severity": q_dq_severity,
    "dq_trend": q_dq_trend,
    "dq_escalation": q_dq_escalation,
    "dq_by_snapshot": q_dq_by_snapshot,
    "malformed_ids": q_malformed_ids,
    "dq_length_check": q_dq_length_check,
    "bronze_file_counts": q_bronze_file_counts,
    "distinct_vendors": q_distinct_vendors,
    "core_by_month": q_core_by_month,
    "index_sync": q_index_sync,
    "continuous_index_sync": q_continuous_index_sync,
    "vuln_enriched": q_vuln_enriched,
    "vendor_risk_agg": q_vendor_risk_agg,
    "kev_recent": q_kev_recent,
    "gold_quality": q_gold_quality,
    "classify_questions": q_classify_questions,
    "lookup_cve": q_lookup_cve,
    "compare_cves": q_compare_cves,
    "not_found_ids": q_not_found_ids,
    "filtered_search": q_filtered_search,
    "filtered_search_all": q_filtered_search_all,
    "answer_filtered": q_answer_filtered,
    "trend_vendors": q_trend_vendors,
    "answer_trends": q_answer_trends,
    "answer_trend_vendors": q_answer_trend_vendors,
    "answer_questions": q_answer_questions,
    "tier_distribution": q_tier_distribution,
    "data_stats": q_data_stats,
    "top_vendors": q_top_vendors,
    "priority_list": q_priority_list,
    "vector_topk": q_vector_topk,
    "vector_topk_filtered": q_vector_topk_filtered,
    "vector_topk_batch": q_vector_topk_batch,
    "vector_topk_indexed": q_vector_topk_indexed,
    "document_vectors": q_document_vectors,
    "semantic_text_search": q_semantic_text_search,
    "tfidf_search": q_tfidf_search,
    "answer_semantic": q_answer_semantic,
    "keyword_fallback": q_keyword_fallback,
    "text_search_filtered": q_text_search_filtered,
    "search_fallback": q_search_fallback,
    "latest_event_per_user": q_latest_event_per_user,
    "incremental_core": q_incremental_core,
    "incremental_products": q_incremental_products,
    "incremental_signals": q_incremental_signals,
    "incremental_events": q_incremental_events,
    "stream_dedup_events": q_stream_dedup_events,
    "stream_ingest": q_stream_ingest,
    "ingest_odd_files": q_ingest_odd_files,
    "ingest_report": q_ingest_report,
    "build_history": q_build_history,
    "build_changes": q_build_changes,
    "catalog_tables": q_catalog_tables,
    "catalog_schemas": q_catalog_schemas,
    "table_inspection": q_table_inspection,
    "csv_export": q_csv_export,
    "fail_rule": q_fail_rule,
}
