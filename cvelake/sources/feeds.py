"""Feed files -> Bronze rows, parsed on the executors.

* NVD: gzip JSON envelopes ``{..., "CVE_data_numberOfCVEs": n, "CVE_Items": [...]}``.
* KEV: JSON envelope with a ``vulnerabilities`` array.
* EPSS: CSV with a header line; ``cve``, ``epss`` and ``percentile`` are found by
  name, in any order; ``#`` comment lines and blank lines are skipped.

No file is ever held whole: envelopes are read item by item (:mod:`.envelopes`), CSV
files line by line. Each item keeps its own JSON text, the CVE id is read from the
current or the legacy layout, rows without an id are dropped, and provenance is
attached: one ``ingest_ts`` per run, the file's base name, and the first ``yyyy-MM-dd``
in the file name (NULL when there is none). Only the plain files of one folder are read,
not its sub-folders.

A file is taken whole or not at all. Whether it is well formed is known at its end, so
:func:`read_files` writes what it has read, with one outcome row a file, and drops the
items of files that failed; the same rows say what was skipped and why.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.session import stage
from cvelake.sources import envelopes

# The snapshot date pattern in file names, the feed file
# suffixes, and the NVD page size (items per file).
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
NVD_GLOB, KEV_GLOB, EPSS_GLOB = "*.json.gz", "*.json", "*.csv"
GLOBS = {"nvd": NVD_GLOB, "kev": KEV_GLOB, "epss": EPSS_GLOB}
#: Name of an envelope's list, and of its declared length.
ENVELOPES = {"nvd": ("CVE_Items", "CVE_data_numberOfCVEs"), "kev": ("vulnerabilities", None)}
PAGE_SIZE = 2000
EPSS_PAGE = 100_000


def snapshot_date() -> Column:
    """First yyyy-MM-dd in the file name; NULL when there is none."""
    d = F.regexp_extract(F.col("_metadata.file_name"), DATE_IN_NAME, 1)
    return F.try_to_date(F.when(d != "", d), "yyyy-MM-dd")


def feed_lines(reader, path: str, glob: str, separator: str | None = None) -> DataFrame:
    """The lines of the feed files of one folder, by a batch or a stream ``reader``;
    with ``separator`` the pieces between its occurrences. Unreadable files end where
    they can't be read further."""
    reader = reader.option("pathGlobFilter", glob).option("ignoreCorruptFiles", True)
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_name").alias("source_file"),
        snapshot_date().alias("snapshot_date"),
    )


def feed_pieces(reader, path: str, kind: str, glob: str | None = None) -> DataFrame:
    """What :func:`parse_files` takes, of the files of one ``kind``."""
    return feed_lines(reader, path, glob or GLOBS[kind], envelopes.SEPARATOR if kind in ENVELOPES else None)


def parse_files(pieces: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(items of the files that are well formed, one outcome row for each file that
    could be opened: file_path, source_file, reason, n_records, declared_records)."""
    if kind == "epss":
        return _parse_csv(pieces)
    if kind not in ENVELOPES:
        raise ValueError(kind)
    # A gzip file is one stream, so one task reads it from its beginning to its end.
    found = stage(envelopes.scan(pieces, *ENVELOPES[kind], in_order=kind == "nvd"), f"{kind}-items")
    outcomes = found.filter("at_end").select("file_path", "source_file", "reason", "n_records", "declared_records")
    good = outcomes.filter(F.col("reason").isNull()).select("file_path")
    return found.filter("NOT at_end").join(good, "file_path", "left_semi"), outcomes


def _parse_csv(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("line", F.trim("value"))
    lines = stage(lines.filter((F.col("line") != "") & ~F.col("line").startswith("#")).drop("value"), "epss-lines")
    # The two first lines of a file, without sorting it: each task sends two at most.
    place = F.struct("block", "at", "line")
    header = lines.groupBy("file_path", "source_file").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    header = header.withColumn("header", _names(F.col("first.line")))
    headed = lines.join(header.select("file_path", "header", "first"), "file_path")
    rows = headed.filter(_names(F.col("line")) != F.col("header"))
    second = rows.groupBy("file_path").agg(F.min(place)["line"].alias("line"))
    cells = F.split("line", ",")
    first_id = F.trim(F.get(cells, F.array_position("header", "cve").cast("int") - 1))
    checked = header.join(second, "file_path", "left")
    reason = (
        F.when(F.col("n") < 2, "header without rows, or empty")
        .when(~_has_columns(F.col("header")), "header lacks cve, epss or percentile")
        .when(F.size(cells) < 2, "rows have too few columns")
        .when(~F.upper(first_id).startswith("CVE-"), "first row has no CVE id")
    )
    none = F.lit(None).cast("long").alias("declared_records")
    outcomes = checked.select("file_path", "source_file", reason.alias("reason"), (F.col("n") - 1).alias("n"), none)
    outcomes = outcomes.select("file_path", "source_file", "reason", F.when(F.col("reason").isNull(), F.col("n")).alias("n_records"), "declared_records")
    return rows.filter(_has_columns(F.col("header"))), outcomes


def _names(line: Column) -> Column:
    return F.transform(F.split(F.lower(line), ","), lambda x: F.trim(x))


def _bronze(items: DataFrame, cve_id: Column, run_ts: str) -> DataFrame:
    return (
        items.withColumn("cve_id", cve_id)
        .filter(F.col("cve_id").isNotNull() & (F.col("cve_id") != ""))
        .select("cve_id", "raw_json", F.lit(run_ts).cast("timestamp").alias("ingest_ts"), "source_file",
                "snapshot_date")
    )


def bronze_of(pieces: DataFrame, kind: str, run_ts: str) -> DataFrame:
    """Bronze rows of the pieces of feed files of one ``kind``."""
    return bronze_items(parse_files(pieces, kind)[0], kind, run_ts)


def bronze_items(items: DataFrame, kind: str, run_ts: str) -> DataFrame:
    if kind == "epss":
        return _epss_rows(items, run_ts)
    if kind == "nvd":  # the id is in the current or in the legacy layout
        cid = F.coalesce(F.get_json_object("raw_json", "$.cve.id"), F.get_json_object("raw_json", "$.cve.CVE_data_meta.ID"))
    else:
        cid = F.get_json_object("raw_json", "$.cveID")
    return _bronze(items, cid, run_ts)


def _has_columns(header: Column) -> Column:
    return F.array_contains(header, "cve") & F.array_contains(header, "epss") & F.array_contains(header, "percentile")


def _epss_rows(rows: DataFrame, run_ts: str) -> DataFrame:
    """(header, line, ...) -> Bronze rows, columns found by name."""
    fields = F.transform(F.split("line", ","), lambda x: F.trim(x))
    named = lambda c: F.get(fields, F.array_position("header", c).cast("int") - 1)
    return rows.select(
        named("cve").alias("cve_id"),
        named("epss").try_cast("double").alias("epss_score"),
        named("percentile").try_cast("double").alias("epss_percentile"),
        F.lit(run_ts).cast("timestamp").alias("ingest_ts"),
        "source_file",
        "snapshot_date",
    )


def read_files(spark: SparkSession, path: str, kind: str, run_ts: str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(Bronze rows, outcomes of all files) of one pass over a folder's feed files;
    outcomes: one row a file, as :func:`file_outcomes` gives them."""
    items, found = parse_files(feed_pieces(spark.read, path, kind, glob), kind)
    return bronze_items(items, kind, run_ts), file_outcomes(list_files(spark, path, glob or GLOBS[kind]), found, kind)


def read_nvd(spark: SparkSession, path: str, run_ts: str, glob: str = NVD_GLOB) -> DataFrame:
    """NVD feed files -> Bronze rows (one per item with an id; legacy layout accepted)."""
    return bronze_of(feed_pieces(spark.read, path, "nvd", glob), "nvd", run_ts)


def read_kev(spark: SparkSession, path: str, run_ts: str, glob: str = KEV_GLOB) -> DataFrame:
    """KEV feed files -> Bronze rows (one per catalog entry with an id)."""
    return bronze_of(feed_pieces(spark.read, path, "kev", glob), "kev", run_ts)


def read_epss(spark: SparkSession, path: str, run_ts: str, glob: str = EPSS_GLOB) -> DataFrame:
    """EPSS CSV files -> Bronze rows with scores cast to double (bad values become
    NULL). Lines are read as they are split; each file's header, its first line
    that is no comment, tells where its columns are."""
    return bronze_of(feed_pieces(spark.read, path, "epss", glob), "epss", run_ts)


def ingest_summary(nvd: DataFrame, kev: DataFrame, epss: DataFrame) -> DataFrame:
    """Rows per source and snapshot, per source, and in total (rollup)."""
    tagged = (
        nvd.select(F.lit("nvd").alias("source"), "snapshot_date")
        .unionByName(kev.select(F.lit("kev").alias("source"), "snapshot_date"))
        .unionByName(epss.select(F.lit("epss").alias("source"), "snapshot_date"))
    )
    return tagged.rollup("source", "snapshot_date").agg(F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------------ validation

def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file_path, length) of the plain files under ``path`` matching ``glob``;
    an empty frame when the folder is missing or unreadable. binaryFile only
    lists: content is not read when only path and length are selected."""
    try:
        return (
            spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .load(path).select(F.col("path").alias("file_path"), "length")
        )
    except AnalysisException:
        return spark.createDataFrame([], "file_path string, length long")


def file_outcomes(listed: DataFrame, found: DataFrame, kind: str) -> DataFrame:
    """One row for each listed file: (file_path, kind, ok, reason, n_records,
    declared_records, count_matches); a file of which nothing was read is unreadable."""
    out = listed.select("file_path").join(found, "file_path", "left")
    reason = F.when(F.col("source_file").isNull(), F.lit("unreadable")).otherwise(F.col("reason"))
    return out.select(
        "file_path", F.lit(kind).alias("kind"), reason.isNull().alias("ok"), reason.alias("reason"),
        "n_records", "declared_records",
        (F.col("declared_records").isNull() | (F.col("declared_records") == F.col("n_records"))).alias("count_matches"),
    )


def validate_files(spark: SparkSession, path: str, kind: str, glob: str | None = None) -> DataFrame:
    """The outcomes of reading a folder's files, without Bronze rows.

    nvd: readable gzip, JSON, ``CVE_Items`` present and a list;
    kev: JSON, ``vulnerabilities`` present and a list;
    epss: at least 2 lines (blank and ``#`` lines ignored), header names
    ``cve``, ``epss`` and ``percentile``, first data row has 2+ fields and a CVE id.
    """
    return read_files(spark, path, kind, "1970-01-01", glob)[1]


def skipped_files(outcomes: DataFrame) -> DataFrame:
    """(kind, source_file, reason) of the files that were not taken."""
    return outcomes.filter(~F.col("ok")).select("kind", F.element_at(F.split("file_path", "/"), -1).alias("source_file"), "reason")


def ingest_report(spark: SparkSession, feed_dir: str, globs: dict[str, str] | None = None) -> DataFrame:
    """The files under ``feed_dir`` that an ingest skips, and why: (kind,
    source_file, reason). An ingest reports them itself (``build.skipped_files``)."""
    found = None
    for kind, glob in (globs or GLOBS).items():
        bad = skipped_files(validate_files(spark, f"{feed_dir}/{kind}", kind, glob))
        found = bad if found is None else found.unionByName(bad)
    return found


# ------------------------------------------------------------------ writing feed files

def _publish(spark: SparkSession, staged: str, out_dir: str, suffix: str) -> None:
    """Gives the one part file of each ``file=<stem>`` folder its feed name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(out_dir))
    for folder in fs.listStatus(path(staged)):
        stem = folder.getPath().getName()
        if stem.startswith("file="):
            for part in fs.listStatus(folder.getPath()):
                if part.getPath().getName().startswith("part-"):
                    fs.rename(part.getPath(), path(f"{out_dir}/{stem[5:]}{suffix}"))
    fs.delete(path(staged), True)


def _write_envelopes(items: DataFrame, stem: Column, head: Column, key: str, out_dir: str, suffix: str) -> None:
    grouped = items.groupBy(stem.alias("file")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cve_id", "raw_json"))), lambda x: x["raw_json"]).alias("items")
    )
    doc = F.concat(F.lit("{"), head, F.lit(f'"{key}":['), F.array_join("items", ","), F.lit("]}"))
    staged = out_dir.rstrip("/") + "-staged"
    writer = grouped.select("file", doc.alias("value")).repartition("file").write.mode("overwrite").partitionBy("file")
    (writer.option("compression", "gzip") if suffix.endswith(".gz") else writer).text(staged)
    _publish(items.sparkSession, staged, out_dir, suffix)


def write_nvd_files(items: DataFrame, out_dir: str, page_size: int = PAGE_SIZE) -> None:
    """Write (n, cve_id, snapshot_date, raw_json) items as gzip envelopes of
    at most ``page_size`` items, one file per page, named by snapshot date."""
    stem = F.concat(F.lit("nvd_modified_"), F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit("_p"),
                    F.format_string("%06d", F.floor(F.col("n") / page_size)))
    head = F.concat(F.lit('"CVE_data_type":"CVE","CVE_data_format":"MITRE","CVE_data_version":"4.0","CVE_data_numberOfCVEs":'),
                    F.size("items").cast("string"), F.lit(","))
    _write_envelopes(items, stem, head, "CVE_Items", out_dir, ".json.gz")


def write_kev_files(entries: DataFrame, out_dir: str, snapshot: str, page_size: int = PAGE_SIZE) -> None:
    """Write KEV entries as JSON envelopes of at most ``page_size`` entries per file."""
    stem = F.concat(F.lit(f"cisa_kev_{snapshot}_p"), F.format_string("%06d", F.floor(F.col("n") / page_size)))
    _write_envelopes(entries, stem, F.lit(f'"catalogVersion":"{snapshot}",'), "vulnerabilities", out_dir, ".json")


def write_epss_files(rows: DataFrame, out_dir: str, page_size: int = EPSS_PAGE) -> None:
    """Write EPSS rows as CSV with header, at most ``page_size`` rows a file,
    named by snapshot date."""
    out = rows.select(
        F.concat(F.lit("epss_"), F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit("_p"),
                 F.format_string("%06d", F.floor(F.col("n") / page_size))).alias("file"),
        F.col("cve_id").alias("cve"),
        F.col("epss_score").cast("string").alias("epss"),
        F.col("epss_percentile").cast("string").alias("percentile"),
    )
    staged = out_dir.rstrip("/") + "-staged"
    out.repartition("file").write.mode("overwrite").partitionBy("file").option("header", True).csv(staged)
    _publish(rows.sparkSession, staged, out_dir, ".csv")
