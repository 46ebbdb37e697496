"""Bronze rows derived from the driver's generic tables.

The driver tables hold no security data, so each feed is derived from them
by formulas that an independent SQL engine can repeat (the correctness
oracle does exactly that). ``n`` is ``documents.doc_id``:

* one NVD item per document and snapshot, carrying the document's text and
  language as its description, CVSS metrics, weaknesses and CPE
  configurations built from ``part`` rows;
* EPSS rows per document, KEV entries per ``labels`` row with ``toxic = 1``;
* two questions per ``conversations`` turn, its text and a template.

Two runs are simulated the way the feeds are loaded: run 1 loads snapshot 1,
run 2 re-reads the folder and appends snapshot 1 again plus snapshot 2, so
both snapshots share run 2's ``ingest_ts`` (the tie the dedup order breaks
by snapshot date).

Fixed values of the fixture (used identically by the oracle SQL):
run 1 = 2024-01-15 06:00:00, run 2 = 2024-01-16 06:00:00,
snapshot 1 = 2024-01-15, snapshot 2 = 2024-01-16, as_of = 2024-03-01.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_1 = "2024-01-15 06:00:00"
RUN_2 = "2024-01-16 06:00:00"
SNAP_1 = "2024-01-15"
SNAP_2 = "2024-01-16"
AS_OF = "2024-03-01"

NVD_FILES = {SNAP_1: "nvd_modified_2024-01-15.json.gz", SNAP_2: "nvd_modified_2024-01-16.json.gz"}
EPSS_FILES = {SNAP_1: "epss_2024-01-15.csv", SNAP_2: "epss_2024-01-16.csv"}
KEV_FILE = "cisa_kev_2024-01-15.json"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. With ``spread``, its rows are rebalanced first, so that
    the per-row work after it (JSON building and parsing, text tokenising) uses
    every core even if the file has one row group; AQE sizes the partitions."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.hint("rebalance") if spread else df


def cve_id_of(n: Column) -> Column:
    """``CVE-<2020 + n % 5>-<n, 5 digits>``; every 97th id is lower-case."""
    prefix = F.when(n % 97 == 0, F.lit("cve-")).otherwise(F.lit("CVE-"))
    return F.concat(prefix, (F.lit(2020) + n % 5).cast("string"), F.lit("-"), F.format_string("%05d", n))


def _empty_like(arr: Column) -> Column:
    return F.filter(arr, lambda x: F.lit(False))


def _severity(score: Column) -> Column:
    return (
        F.when(score == 0, "NONE").when(score < 4, "LOW").when(score < 7, "MEDIUM")
        .when(score < 9, "HIGH").otherwise("CRITICAL")
    )


def _vendor(part_key: Column, brand: Column) -> Column:
    """Vendor of a part: its brand as one word (``brand_13``), hyphenated
    (``brand-13``) or of several words (``brand_13_software.inc``)."""
    name = F.lower(F.regexp_replace(brand, "#", "_"))
    return (
        F.when(part_key % 5 == 1, F.regexp_replace(name, "_", "-"))
        .when(part_key % 5 == 3, F.concat(name, F.lit("_software.inc")))
        .otherwise(name)
    )


def cpe_lists(docs: DataFrame, part: DataFrame) -> DataFrame:
    """(n, cpes): 1..4 CPE match entries for each document ``n``. Entry k points
    at part key (7 n + 13 k) mod the number of parts; entries whose key is
    absent are left out. Only keys meet ``part``; texts are dealt once by ``n``,
    where they meet these lists."""
    n, k = F.col("n"), F.col("k")
    n_parts = part.agg(F.count(F.lit(1))).scalar()
    wanted = docs.select("n", F.explode(F.sequence(F.lit(0).cast("long"), n % 4)).alias("k"))
    wanted = wanted.withColumn("_parts", n_parts).withColumn("p_partkey", (n * 7 + k * 13) % F.col("_parts"))
    p = part.select(
        "p_partkey",
        _vendor(F.col("p_partkey"), F.col("p_brand")).alias("brand"),
        F.regexp_replace("p_name", " ", "_").alias("pname"),
        F.col("p_size").cast("string").alias("psize"),
    )
    vendor = F.when((n + k) % 11 == 0, F.lit("*")).otherwise(F.col("brand"))
    product = F.when((n + k) % 13 == 0, F.lit("-")).otherwise(F.col("pname"))
    criteria = F.concat_ws(":", F.lit("cpe"), F.lit("2.3"), F.lit("a"), vendor, product, F.col("psize"), *[F.lit("*")] * 7)
    entry = F.struct(
        ((n + k) % 5 != 0).alias("vulnerable"),
        criteria.alias("criteria"),
        F.concat(F.lit("m-"), n.cast("string"), F.lit("-"), k.cast("string")).alias("matchCriteriaId"),
    )
    found = wanted.join(p, "p_partkey").groupBy("n").agg(F.array_sort(F.collect_list(F.struct("k", entry.alias("entry")))).alias("found"))
    return found.select("n", F.transform("found", lambda x: x["entry"]).alias("cpes"))


def _snapshots(has_v2: Column) -> Column:
    s1 = F.struct(F.lit(SNAP_1).cast("date").alias("snapshot_date"), F.lit(1).alias("v"))
    s2 = F.struct(F.lit(SNAP_2).cast("date").alias("snapshot_date"), F.lit(2).alias("v"))
    return F.when(has_v2, F.array(s1, s2)).otherwise(F.array(s1))


def nvd_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One NVD item per document and snapshot: (n, cve_id, snapshot_date, raw_json)."""
    n = F.col("n")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"), "text", "lang")
    keys = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"))
    lists = cpe_lists(keys, table(spark, sf_dir, "part"))
    no_cpes = F.array().cast("array<struct<vulnerable:boolean,criteria:string,matchCriteriaId:string>>")
    # Dealt once, by this join, which also spreads the JSON work over all cores.
    docs = docs.join(lists.hint("shuffle_hash"), "n", "left").withColumn("cpes", F.coalesce("cpes", no_cpes))
    rows = docs.select("*", F.inline(_snapshots(n % 4 == 0)))
    v = F.col("v")
    cid = cve_id_of(n)
    s1 = (n % 101) / F.lit(10.0)
    score = F.when(v == 2, F.least(s1 + F.lit(0.1), F.lit(10.0))).otherwise(s1)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (n % 365).cast("int"))
    published = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000"))
    modified = (
        F.when(v == 2, F.lit("2024-01-16T08:00:00.000"))
        .when(n % 53 == 0, F.lit("not-a-date"))
        .otherwise(F.concat(F.date_format(F.date_add(day, (n % 13).cast("int")), "yyyy-MM-dd"), F.lit("T12:30:00.000")))
    )
    desc = F.array(F.struct(F.col("lang").alias("lang"), F.col("text").alias("value")))
    descriptions = F.when((v == 2) & (n % 28 == 0), _empty_like(desc)).otherwise(desc)

    def cvss3(version: str) -> Column:
        return F.array(F.struct(F.struct(
            score.alias("baseScore"), _severity(score).alias("baseSeverity"),
            F.lit(f"CVSS:{version}/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H").alias("vectorString"),
        ).alias("cvssData")))

    v31 = cvss3("3.1")
    metrics = F.struct(
        F.when(n % 3 == 0, v31).when((n % 3 == 1) & (n % 7 == 0), _empty_like(v31)).alias("cvssMetricV31"),
        F.when(n % 3 == 1, cvss3("3.0")).alias("cvssMetricV30"),
        F.when(n % 4 == 0, F.array(F.struct(F.struct(
            (n % 11).cast("double").alias("baseScore"),
            F.lit("AV:N/AC:L/Au:N/C:P/I:P/A:P").alias("vectorString"),
        ).alias("cvssData")))).alias("cvssMetricV2"),
    )
    en_cwe = F.struct(F.array(F.struct(
        F.lit("en").alias("lang"), F.concat(F.lit("CWE-"), (n % 40).cast("string")).alias("value"),
    )).alias("description"))
    no_desc = F.struct(F.lit(None).cast("array<struct<lang:string,value:string>>").alias("description"))
    weaknesses = F.when(n % 5 != 0, F.when(n % 49 == 0, F.array(en_cwe, no_desc)).otherwise(F.array(en_cwe)))
    configurations = F.array(F.struct(F.array(F.struct(
        F.lit("OR").alias("operator"), F.lit(False).alias("negate"), F.col("cpes").alias("cpeMatch"),
    )).alias("nodes")))
    item = F.struct(F.struct(
        cid.alias("id"), published.alias("published"), modified.alias("lastModified"),
        descriptions.alias("descriptions"), metrics.alias("metrics"),
        weaknesses.alias("weaknesses"), configurations.alias("configurations"),
    ).alias("cve"))
    legacy = F.struct(F.struct(F.struct(cid.alias("ID")).alias("CVE_data_meta")).alias("cve"))
    raw = F.when((v == 1) & (n % 89 == 0), F.to_json(legacy)).otherwise(F.to_json(item))
    return rows.select("n", cid.alias("cve_id"), "snapshot_date", raw.alias("raw_json"))


def _runs(files: dict[str, str]) -> Column:
    """The loads that put a snapshot row into Bronze: snapshot 1 by run 1 and
    again by run 2 (which re-reads the folder), snapshot 2 by run 2."""
    def load(run: str, snap: str) -> Column:
        return F.struct(F.lit(run).cast("timestamp").alias("ingest_ts"), F.lit(files[snap]).alias("source_file"))

    return F.when(F.col("snapshot_date") == F.lit(SNAP_1).cast("date"),
                  F.array(load(RUN_1, SNAP_1), load(RUN_2, SNAP_1))).otherwise(F.array(load(RUN_2, SNAP_2)))


def bronze_nvd(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = nvd_items(spark, sf_dir)
    return items.select("cve_id", "raw_json", F.inline(_runs(NVD_FILES)), "snapshot_date").select(
        "cve_id", "raw_json", "ingest_ts", "source_file", "snapshot_date"
    )


def epss_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One EPSS row per document (n % 10 <> 9) and snapshot."""
    n = F.col("n")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("n")).filter(n % 10 != 9)
    rows = docs.select("n", F.inline(_snapshots(n % 6 == 0)))
    v = F.col("v")
    score = (
        F.when(v == 2, ((n * 7919 + 500) % 1000) / F.lit(1000.0))
        .when(n % 211 == 0, F.lit(1.5))
        .when(n % 67 == 0, F.lit(None).cast("double"))
        .otherwise(((n * 7919) % 1000) / F.lit(1000.0))
    )
    return rows.select(
        "n", cve_id_of(n).alias("cve_id"), "snapshot_date",
        score.alias("epss_score"), (((n * 31) % 1000) / F.lit(1000.0)).alias("epss_percentile"),
    )


def bronze_epss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epss_rows(spark, sf_dir).select(
        "cve_id", "epss_score", "epss_percentile", F.inline(_runs(EPSS_FILES)), "snapshot_date"
    ).select("cve_id", "epss_score", "epss_percentile", "ingest_ts", "source_file", "snapshot_date")


def kev_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One KEV catalog entry per labels row with toxic = 1: (n, cve_id, raw_json)."""
    n = F.col("n")
    lab = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(F.col("doc_id").alias("n"))
    added = F.date_add(F.lit("2024-01-01").cast("date"), (n % 60).cast("int"))
    cid = cve_id_of(n)
    entry = F.struct(
        cid.alias("cveID"),
        F.concat(F.lit("brand_"), (n % 25 + 1).cast("string")).alias("vendorProject"),
        F.concat(F.lit("product_"), (n % 7).cast("string")).alias("product"),
        F.concat(F.lit("Vulnerability "), n.cast("string")).alias("vulnerabilityName"),
        F.when(n % 17 == 0, F.lit("unknown")).otherwise(F.date_format(added, "yyyy-MM-dd")).alias("dateAdded"),
        F.date_format(F.date_add(added, 21), "yyyy-MM-dd").alias("dueDate"),
        F.when(n % 2 == 0, F.lit("Known")).otherwise(F.lit("Unknown")).alias("knownRansomwareCampaignUse"),
        F.concat(F.lit("Advisory "), n.cast("string")).alias("notes"),
        F.lit("Exploited in the wild.").alias("shortDescription"),
    )
    return lab.select("n", cid.alias("cve_id"), F.to_json(entry).alias("raw_json"))


def bronze_kev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one KEV snapshot, loaded by run 1 and re-loaded by run 2."""
    loads = F.array(*[
        F.struct(F.lit(r).cast("timestamp").alias("ingest_ts")) for r in (RUN_1, RUN_2)
    ])
    return kev_entries(spark, sf_dir).select(
        "cve_id", "raw_json", F.inline(loads),
        F.lit(KEV_FILE).alias("source_file"), F.lit(SNAP_1).cast("date").alias("snapshot_date"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two questions per conversation turn, (question_id, raw_query): the turn's
    whole text, and a template question made from the turn's keys."""
    c = table(spark, sf_dir, "conversations", spread=True)
    conv, turn = F.col("conv_id"), F.col("turn")
    m = (conv + turn) % 7
    x, y = cve_id_of(conv), cve_id_of(conv + 1)
    number = (conv % 25 + 1).cast("string")
    brand = F.concat(F.lit("brand_"), number)
    # The same vendors the way people write them.
    spoken = F.when(conv % 3 == 0, F.concat(F.lit("Brand "), number, F.lit(" Software, Inc."))).when(
        conv % 3 == 1, F.concat(F.lit("Brand-"), number)).otherwise(brand)
    since = F.concat(F.lit(" since 2024-01-"), F.format_string("%02d", conv % 28 + 1))
    template = (
        F.when(m == 0, F.concat(F.lit("What is "), x, F.lit("?")))
        .when(m == 1, F.concat(F.lit("Compare "), x, F.lit(" and "), y))
        .when(m == 2, F.concat(F.lit("Critical vulns in "), spoken, since))
        .when(m == 3, F.concat(F.lit("Latest critical or high vulns in "), spoken, F.lit(" in the last "),
                               (conv % 120 + 1).cast("string"), F.lit(" days")))
        .when(m == 4, F.lit("What's exploited this month?"))
        .when(m == 5, F.concat(F.lit("KEV vulnerabilities affecting "), spoken, F.lit(" in the last "),
                               (conv % 90 + 1).cast("string"), F.lit(" days")))
        .otherwise(F.lit(""))
    )
    both = F.array(F.struct(F.lit(0).cast("long").alias("k"), F.col("text").alias("raw_query")),
                   F.struct(F.lit(1).cast("long").alias("k"), template.alias("raw_query")))
    asked = c.select("conv_id", "turn", F.inline(both))
    return asked.select(((conv * 1000 + turn) * 2 + F.col("k")).alias("question_id"), "raw_query")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings keyed to CVEs: vec_id n is the vector of document n."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(cve_id_of(F.col("vec_id")).alias("cve_id"), "vec_id", "embedding", "label")
