"""Silver tables: parsed, deduplicated, quality-checked.

Each ``*_records`` function returns the deduplicated rows *before* the
table's expectations (what the rules are counted on); the plain table
function applies the rules. Dedup runs before the quality drop, so a CVE
whose newest record lacks an English description disappears even if an
older record had one.

All keyed work (dedup windows, the EPSS x KEV join, the product
aggregation and the document joins) is hash-partitioned on ``cve_id``, so
the joins in :func:`cve_documents` reuse the partitioning of their inputs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cvelake.functions.columns import (
    CPE_PRODUCT, CPE_VENDOR, CPE_VERSION, cpe_field, cpe_parts, first_value, labelled, pipe_joined,
)
from cvelake.operators.dedup import TIEBREAK, content_hash, latest_per_key
from cvelake.operators.quality import Expectation, apply_expectations, counted, counted_metrics, expectation_metrics
from cvelake.schemas import (
    AFFECTED_PRODUCTS_COLUMNS, CVE_CORE_COLUMNS, CVE_DOCUMENTS_COLUMNS, CVE_SIGNALS_COLUMNS, KEV_ITEM, NVD_ITEM,
)
from cvelake.session import stage

# Rule names, predicates and actions of the Silver tables.
CORE_RULES = (
    Expectation("valid_cve_id", "cve_id IS NOT NULL"),
    Expectation("valid_cve_format", "cve_id RLIKE '^CVE-[0-9]{4}-[0-9]+$'"),
    Expectation("has_description", "description IS NOT NULL", "drop"),
)
SIGNALS_RULES = (
    Expectation("valid_epss_range", "epss_score IS NULL OR (epss_score >= 0 AND epss_score <= 1)"),
)
PRODUCTS_RULES = (
    Expectation("valid_cve_id", "cve_id IS NOT NULL"),
    Expectation("valid_cpe_uri", "cpe_uri IS NOT NULL"),
    Expectation("has_vendor", "vendor IS NOT NULL", "drop"),
)
DOCUMENTS_RULES = (
    Expectation("valid_cve_id", "cve_id IS NOT NULL"),
    Expectation("has_document_text", "LENGTH(document_text) > 50", "drop"),
)

PROVENANCE = ("ingest_ts", "snapshot_date", "source_file", TIEBREAK)


def parse_nvd(bronze_nvd: DataFrame) -> DataFrame:
    """Bronze NVD rows with the item parsed once under the merged schema."""
    return bronze_nvd.select(
        "cve_id", F.from_json("raw_json", NVD_ITEM).alias("p"), *PROVENANCE[:3], content_hash("raw_json"),
    )


def _item_id() -> Column:
    # The parsed id wins; a legacy item has none, so the Bronze id stands in.
    return F.coalesce(F.col("p.cve.id"), F.col("cve_id"))


def core_rows(parsed: DataFrame) -> DataFrame:
    """Core fields of every Bronze row (no dedup), with provenance."""
    cve = F.col("p.cve")
    v31 = F.get(cve["metrics"]["cvssMetricV31"], 0)["cvssData"]
    v30 = F.get(cve["metrics"]["cvssMetricV30"], 0)["cvssData"]
    v2 = F.get(cve["metrics"]["cvssMetricV2"], 0)["cvssData"]
    # FLATTEN is NULL when any weakness lacks a description: cwe_id is then NULL.
    cwe = F.flatten(F.transform(cve["weaknesses"], lambda w: w["description"]))
    return parsed.select(
        _item_id().alias("cve_id"),
        F.try_to_timestamp(cve["published"]).alias("published"),
        F.try_to_timestamp(cve["lastModified"]).alias("last_modified"),
        first_value(cve["descriptions"]).alias("description"),
        # v3.1 first, v3.0 second, each field on its own.
        F.coalesce(v31["baseScore"], v30["baseScore"]).alias("cvss_v3_score"),
        F.coalesce(v31["baseSeverity"], v30["baseSeverity"]).alias("cvss_v3_severity"),
        F.coalesce(v31["vectorString"], v30["vectorString"]).alias("cvss_v3_vector"),
        v2["baseScore"].alias("cvss_v2_score"),
        first_value(cwe).alias("cwe_id"),
        *PROVENANCE,
    )


def cve_core_records(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Latest core record per cve_id, before the core rules."""
    return latest_per_key(core_rows(parsed), ["cve_id"]).select(*CVE_CORE_COLUMNS, *keep)


def cve_core(bronze_nvd: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """The cve_core table: latest record per CVE, rules applied (no English description: dropped)."""
    return apply_expectations(cve_core_records(parsed if parsed is not None else parse_nvd(bronze_nvd)), CORE_RULES)


def latest_epss(bronze_epss: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Latest EPSS score and percentile per cve_id."""
    return latest_per_key(epss_rows(bronze_epss), ["cve_id"]).select("cve_id", "epss_score", "epss_percentile", *keep)


def epss_rows(bronze_epss: DataFrame) -> DataFrame:
    """EPSS Bronze rows with the dedup tiebreak (no dedup)."""
    return bronze_epss.withColumn(TIEBREAK, content_hash("epss_score", "epss_percentile"))


def kev_rows(bronze_kev: DataFrame) -> DataFrame:
    """KEV entries parsed, with provenance (no dedup)."""
    p = F.from_json("raw_json", KEV_ITEM)
    return bronze_kev.select(
        F.coalesce(p["cveID"], F.col("cve_id")).alias("cve_id"),
        F.try_to_date(p["dateAdded"], "yyyy-MM-dd").alias("kev_date_added"),
        F.try_to_date(p["dueDate"], "yyyy-MM-dd").alias("kev_due_date"),
        p["knownRansomwareCampaignUse"].alias("kev_ransomware_use"),
        p["notes"].alias("kev_notes"),
        *PROVENANCE[:3],
        content_hash("raw_json"),
    )


def latest_kev(bronze_kev: DataFrame) -> DataFrame:
    """Latest KEV entry per cve_id, flagged kev_flag = true."""
    return latest_per_key(kev_rows(bronze_kev), ["cve_id"]).select(
        "cve_id", "kev_date_added", "kev_due_date", "kev_ransomware_use", "kev_notes",
        F.lit(True).alias("kev_flag"),
    )


def cve_signals_records(bronze_epss: DataFrame, bronze_kev: DataFrame) -> DataFrame:
    """EPSS and KEV joined per CVE, before the signals rule."""
    return signals_from_latest(latest_epss(bronze_epss), latest_kev(bronze_kev))


def signals_from_latest(epss: DataFrame, kev: DataFrame) -> DataFrame:
    """Signals from the latest EPSS row and latest KEV entry per CVE."""
    # Full outer join: a CVE in either feed gets a row (the KEV side is small,
    # but a full outer join cannot broadcast). In the batch path both sides
    # arrive partitioned by cve_id from their dedup windows, so the join adds
    # no exchange.
    kev = kev.select("cve_id", "kev_date_added", "kev_due_date", "kev_ransomware_use", "kev_notes",
                     F.lit(True).alias("kev_flag"))
    j = epss.select("cve_id", "epss_score", "epss_percentile").join(kev, "cve_id", "full_outer")
    return j.select(
        "cve_id", "epss_score", "epss_percentile",
        F.coalesce(F.col("kev_flag"), F.lit(False)).alias("kev_flag"),
        "kev_date_added", "kev_due_date", "kev_ransomware_use", "kev_notes",
    ).select(*CVE_SIGNALS_COLUMNS)


def cve_signals(bronze_epss: DataFrame, bronze_kev: DataFrame) -> DataFrame:
    """The cve_signals table (its EPSS range rule only warns)."""
    return apply_expectations(cve_signals_records(bronze_epss, bronze_kev), SIGNALS_RULES)


def product_rows(parsed: DataFrame, escape_aware: bool = False) -> DataFrame:
    """Vulnerable CPE rows of every Bronze row (no dedup), with provenance."""
    # Inner explodes: rows without configurations would be removed by the
    # vulnerable filter right after anyway.
    cfg = parsed.select(_item_id().alias("cve_id"), F.explode("p.cve.configurations").alias("c"), *PROVENANCE)
    nodes = cfg.select("cve_id", F.explode("c.nodes").alias("node"), *PROVENANCE)
    matches = nodes.select("cve_id", F.explode("node.cpeMatch").alias("m"), *PROVENANCE)
    vuln = matches.filter(F.col("m.vulnerable")).select("cve_id", F.col("m.criteria").alias("cpe_uri"), *PROVENANCE)
    parts = cpe_parts(F.col("cpe_uri"), escape_aware)
    rows = vuln.select(
        "cve_id", "cpe_uri",
        cpe_field(parts, CPE_VENDOR).alias("vendor"),
        cpe_field(parts, CPE_PRODUCT).alias("product"),
        cpe_field(parts, CPE_VERSION).alias("version"),
        *PROVENANCE,
    )
    return rows


def affected_products_records(parsed: DataFrame, escape_aware: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Latest row per (cve_id, cpe_uri) of the vulnerable CPEs, before the rules."""
    rows = product_rows(parsed, escape_aware)
    return latest_per_key(rows, ["cve_id", "cpe_uri"]).select(*AFFECTED_PRODUCTS_COLUMNS, *keep)


def cve_affected_products(bronze_nvd: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """The cve_affected_products table (rows without a vendor dropped)."""
    p = parsed if parsed is not None else parse_nvd(bronze_nvd)
    return apply_expectations(affected_products_records(p), PRODUCTS_RULES)


def product_lists(products: DataFrame) -> DataFrame:
    """Per CVE: distinct vendors and products, sorted, joined by `` | ``.

    ``collect_set`` de-duplicates map-side, so what crosses the shuffle per
    CVE is bounded by its distinct vendors/products, not its CPE rows.
    """
    return products.groupBy("cve_id").agg(
        pipe_joined(F.collect_set("vendor")).alias("vendors_str"),
        pipe_joined(F.collect_set("product")).alias("products_str"),
    )


def cve_documents_records(core: DataFrame, signals: DataFrame, products: DataFrame) -> DataFrame:
    """Core, signals and product lists joined into one searchable text per CVE."""
    return document_columns(core.join(signals, "cve_id", "left").join(product_lists(products), "cve_id", "left"))


def document_columns(j: DataFrame) -> DataFrame:
    """The documents' columns of core joined with signals and product lists."""
    text = F.concat_ws(
        " | ",
        F.col("description"),
        labelled("Affected vendors: ", F.col("vendors_str")),
        labelled("Affected products: ", F.col("products_str")),
        labelled("Weakness: ", F.col("cwe_id")),
    )
    return j.select(
        "cve_id", text.alias("document_text"), "published", "cvss_v3_score", "cvss_v3_severity", "epss_score",
        F.coalesce(F.col("kev_flag"), F.lit(False)).alias("kev_flag"), "vendors_str", "products_str", "cwe_id",
    ).select(*CVE_DOCUMENTS_COLUMNS)


def cve_documents(core: DataFrame, signals: DataFrame, products: DataFrame) -> DataFrame:
    """The cve_documents table (texts of 50 characters or fewer dropped)."""
    return apply_expectations(cve_documents_records(core, signals, products), DOCUMENTS_RULES)


class Silver(NamedTuple):
    core: DataFrame
    signals: DataFrame
    products: DataFrame
    documents: DataFrame


def silver_tables(bronze_nvd: DataFrame, bronze_epss: DataFrame, bronze_kev: DataFrame) -> Silver:
    """All four Silver tables as lazy plans over the Bronze frames."""
    parsed = parse_nvd(bronze_nvd)
    core = cve_core(bronze_nvd, parsed)
    signals = cve_signals(bronze_epss, bronze_kev)
    products = cve_affected_products(bronze_nvd, parsed)
    return Silver(core, signals, products, cve_documents(core, signals, products))


class Records(NamedTuple):
    """Deduplicated rows before the expectations: what the rules count on."""
    core: DataFrame
    signals: DataFrame
    products: DataFrame
    #: The counts by rule that were taken while the records were written.
    seen: tuple[Observation, ...] = ()


RECORD_RULES = (("cve_core", CORE_RULES), ("cve_signals", SIGNALS_RULES), ("cve_affected_products", PRODUCTS_RULES))


def silver_records(bronze_nvd: DataFrame, bronze_epss: DataFrame, bronze_kev: DataFrame,
                   staged: bool = False, keep: Sequence[str] = (), written: bool = False,
                   core_path: str | None = None) -> Records:
    """Pre-rule records of core, signals and products. Bronze is parsed once and written;
    if it is a ``written`` table itself, both branches parse what they need of it instead.
    With ``staged`` each is written once to the shared folder, and its rows are counted
    by rule meanwhile, so the clean tables read it instead of re-parsing Bronze and the
    metrics read nothing. With ``core_path`` the core records are counted as they are
    written there as the clean table, which stands for them. ``keep`` carries
    provenance columns (e.g. source_file) on core and products records."""
    parsed = parse_nvd(bronze_nvd)
    if staged and not written:  # both branches read the parsed rows, not the payload
        parsed = stage(parsed, "nvd-parsed")
    r = Records(cve_core_records(parsed, keep=keep), cve_signals_records(bronze_epss, bronze_kev),
                affected_products_records(parsed, keep=keep))
    if staged:
        tables, seen = [], []
        for df, (name, rules) in zip((r.core, r.signals, r.products), RECORD_RULES, strict=True):
            df, counts = counted(df, rules, name)
            if name == "cve_core" and core_path is not None:
                apply_expectations(df, rules).select(*CVE_CORE_COLUMNS).write.mode("overwrite").parquet(core_path)
                tables.append(df.sparkSession.read.parquet(core_path))
            else:
                tables.append(stage(df, f"records-{name}"))
            seen.append(counts)
        r = Records(*tables, seen=tuple(seen))
    return r


def tables_from_records(r: Records) -> Silver:
    """Clean Silver tables (contract columns) from pre-rule records."""
    core = apply_expectations(r.core, CORE_RULES).select(*CVE_CORE_COLUMNS)
    signals = apply_expectations(r.signals, SIGNALS_RULES).select(*CVE_SIGNALS_COLUMNS)
    products = apply_expectations(r.products, PRODUCTS_RULES).select(*AFFECTED_PRODUCTS_COLUMNS)
    return Silver(core, signals, products, cve_documents(core, signals, products))


def record_metrics(r: Records, run_ts: str) -> DataFrame:
    """Expectation metrics of core, signals and products: as counted while they were
    written, else by a scan of each."""
    if r.seen:
        parts = [counted_metrics(r.core.sparkSession, seen, rules, name, run_ts) for seen, (name, rules) in zip(r.seen, RECORD_RULES, strict=True)]
    else:
        parts = [expectation_metrics(df, rules, name, run_ts) for df, (name, rules) in zip((r.core, r.signals, r.products), RECORD_RULES, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def metrics_from_records(r: Records, run_ts: str) -> DataFrame:
    """Expectation metrics of all four Silver tables for one run."""
    t = tables_from_records(r)
    documents = cve_documents_records(t.core, t.signals, t.products)
    return record_metrics(r, run_ts).unionByName(expectation_metrics(documents, DOCUMENTS_RULES, "cve_documents", run_ts))


def silver_metrics(bronze_nvd: DataFrame, bronze_epss: DataFrame, bronze_kev: DataFrame, run_ts: str,
                   staged: bool = False) -> DataFrame:
    """Expectation metrics of all four Silver tables for one run."""
    return metrics_from_records(silver_records(bronze_nvd, bronze_epss, bronze_kev, staged), run_ts)
