"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds are found by pattern in each whole text. The method takes every base
find and every other long mixed string as a candidate, hashes it, and counts over
the whole corpus in how many repositories and by how many owners it is found.
What several owners hold, or very many repositories of whatever owners, is a widely
copied example; a string that stays with its owner and looks random is a live-looking
credential, a base find like any other (``password=changeme`` is a base find, but not
live). Owner-specific strings that no base find covers are spans of their own, of
kind ``owned``.

Positions: the text is split at the pattern, so a match starts where the pieces
and matches before it end; positions count code points, ends are exclusive. Matches
become rows, and their positions a running sum over them; whether a base find covers
a string is a running maximum of the ends of finds that start no later. Redaction cuts
a text into pieces of ``PIECE`` code points and mends the pieces that a span touches.
So the work of a text is linear in its length and its finds.

Skew: counts go through (hash, owner, repository) and (hash, owner) partial
aggregates, and hashes join a written table of counts, whose hot keys Spark splits.

Defined results: a null or empty text has no spans; a null owner counts as one
owner, a null repository as one repository; repeated rows count once and each keeps
its own result; an empty table gives no rows. Carried columns are kept in a struct,
so that their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvelake.session import stage

# Kinds in the order of the contract, and their patterns.
KINDS = ["assign", "access", "hex", "owned"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a shorter run can't hold a longer one, so the length may be in the pattern
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Words of documentation values, which are never live-looking.
PLACEHOLDERS = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0000|1234567"
#: A hash that so many owners hold is a copied example.
COPIED_OWNERS = 3
#: So is one that so many repositories hold, be they of one owner.
COPIED_REPOSITORIES = 10

#: Code points of a piece of a text that is redacted.
PIECE = 2048

_SPAN = "array<struct<start:int,kind:int,end:int,hash:string,live:boolean>>"
_MATCH = "array<struct<kind:int,place:int,gap:int,size:int,hash:string,live:boolean,keep:boolean>>"


def _matches(text: Column, pattern: str, kind: int, group: int, keep) -> Column:
    """Matches of ``pattern`` with the length of the text between one and the next,
    and whether their match and group pass ``keep``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.transform(F.split(text, pattern, -1), F.length)
    parts = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.slice(between, 1, F.size(whole)).alias("gap"))

    def match(m: Column, place: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), place.alias("place"), m["gap"].alias("gap"), F.length(m["whole"]).alias("size"),
            F.sha2(m["value"], 256).alias("hash"), _live_looking(m["value"]).alias("live"), keep(m).alias("keep"),
        )

    return F.when(text.rlike(pattern), F.transform(parts, match)).otherwise(F.array().cast(_MATCH))


def _live_looking(value: Column) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (distinct >= 8) & ~value.rlike(PLACEHOLDERS)


def all_matches(text: Column) -> Column:
    """Matches of the three base kinds and of long mixed strings."""
    return F.concat(
        _matches(text, ASSIGN, 0, 2, lambda m: F.length(m["value"]) >= LEAST_VALUE),
        _matches(text, ACCESS, 1, 0, lambda m: F.length(m["whole"]) >= LEAST_ACCESS),
        _matches(text, HEX, 2, 0, lambda m: F.lit(True)),
        _matches(text, MIXED, 3, 0, lambda m: _live_looking(m["whole"])),
    )


def scan(docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source", copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """Columns: ``row`` (a struct of the columns of ``docs`` other than the text),
    ``base`` and ``spans`` (arrays of (start, kind, end, hash, live) by start, then
    kind), ``n_live`` and ``n_copied`` (candidates that are owner-specific and look
    live, or are copied) and ``most_repositories`` (those that hold the candidate that
    is found in most; 0 without a candidate)."""
    carried = [c for c in docs.columns if c.lower() != text.lower()]
    found, judged = _scan(docs, F.struct(*[F.col(f"`{c}`") for c in carried]), text, repository, owner, copied_owners, copied_repositories)
    span = F.struct("start", "kind", "end", "hash", "live")
    per_row = judged.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") < 3, span))).alias("base"),
        F.array_sort(F.collect_list(F.when((F.col("kind") < 3) | F.col("owned"), span))).alias("spans"),
        F.count_if(~F.col("copied") & F.col("live")).alias("n_live"),
        F.count_if("copied").alias("n_copied"),
        F.max("repositories").alias("most_repositories"),
    )
    # Only rows that hold a match are joined; the others stay where they are.
    counted = found.filter(F.size("matches") > 0).join(per_row, "uid", "left")
    none = F.array().cast(_SPAN)
    empty = {"base": none, "spans": none, "n_live": F.lit(0), "n_copied": F.lit(0), "most_repositories": F.lit(0)}
    clean = found.filter(F.size("matches") == 0).select("row", *[v.alias(c) for c, v in empty.items()])
    filled = [F.coalesce(c, v).cast(_SPAN if c in ("base", "spans") else "long").alias(c) for c, v in empty.items()]
    return counted.select(clean.columns).unionByName(clean).select("row", *filled)


def redact(docs: DataFrame, repository: str = "doc_id", owner: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``; overlapping spans
    become one mark. Null texts stay null; clean texts stay as they are."""
    found, judged = _scan(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]), "text", repository, owner, COPIED_OWNERS, COPIED_REPOSITORIES)
    hidden = judged.filter((F.col("kind") < 3) | F.col("owned")).select("uid", "start", "end")
    # Spans that overlap are one: a span begins where none before it reaches.
    before = Window.partitionBy("uid").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(reach > F.col("start"), 0).otherwise(1)).over(before)
    runs = hidden.withColumn("run", run).groupBy("uid", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    at = F.explode(F.sequence(F.floor(F.col("start") / PIECE), F.floor((F.col("end") - 1) / PIECE)))
    own = F.struct(
        F.greatest(F.col("start") - F.col("piece") * PIECE, F.lit(0)).cast("int").alias("start"),
        F.least(F.col("end") - F.col("piece") * PIECE, F.lit(PIECE)).cast("int").alias("end"),
        (F.floor(F.col("start") / PIECE) == F.col("piece")).alias("begins"),
    )
    # A piece has at most PIECE spans.
    cuts = runs.select("uid", "start", "end", at.alias("piece")).groupBy("uid", "piece").agg(F.array_sort(F.collect_list(own)).alias("cuts"))
    touched = stage(cuts, "secret_cuts")

    spoilt = found.filter(F.size("matches") > 0).join(touched.select("uid").distinct(), "uid", "left_semi")
    pieces = spoilt.select("uid", F.posexplode(F.regexp_extract_all("row.text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("piece", "part"))
    mended = pieces.join(touched, ["uid", "piece"], "left").select("uid", "piece", _mended(mark).alias("part"))
    texts = mended.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("parts"))
    texts = texts.select("uid", F.array_join("parts.part", "").alias("redacted"))
    # Only rows with a match are joined; the others stay where they are.
    some = found.filter(F.size("matches") > 0).join(texts, "uid", "left")
    every = some.select("row", "redacted").unionByName(found.filter(F.size("matches") == 0).select("row", F.lit(None).cast("string").alias("redacted")))
    return every.select(*[F.coalesce("redacted", "row.text").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _mended(mark: str) -> Column:
    """A piece of a text without what its cuts cover; a mark where a span begins."""

    def step(acc: Column, c: Column) -> Column:
        out = F.concat(acc["out"], F.substring(F.col("part"), acc["at"] + 1, c["start"] - acc["at"]), F.when(c["begins"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(c["end"].alias("at"), out.alias("out"))

    cut = F.aggregate("cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.col("cuts").isNull(), F.col("part")).otherwise(F.concat(cut["out"], F.substring(F.col("part"), cut["at"] + 1, F.lit(PIECE))))


def _scan(docs: DataFrame, row: Column, text: str, repository: str, owner: str, copied_owners: int, copied_repositories: int) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs``, written, with their number ``uid`` and ``matches``; their
    candidates with what the corpus says of each: owned or copied)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    found = docs.select(
        row.alias("row"), key(repository).alias("repository"), key(owner).alias("owner"),
        F.monotonically_increasing_id().alias("uid"), all_matches(whole).alias("matches"),
    )
    found = stage(found, "secret_matches")  # row numbers are fixed from here on

    # Both windows and the last grouping of a row's finds go by its number.
    matches = found.filter(F.size("matches") > 0).select("uid", "repository", "owner", F.inline("matches")).repartition("uid")
    in_order = Window.partitionBy("uid", "kind").orderBy("place")
    ends = matches.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(in_order).cast("int"))
    kept = ends.filter("keep").withColumn("start", F.col("end") - F.col("size"))
    until = Window.partitionBy("uid").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.coalesce(F.max(F.when(F.col("kind") < 3, F.col("end"))).over(until) >= F.col("end"), F.lit(False))
    candidates = kept.withColumn("covered", covered).filter((F.col("kind") < 3) | ~F.col("covered"))
    candidates = stage(candidates.select("uid", "repository", "owner", "kind", "start", "end", "hash", "live"), "secret_candidates")

    by_repository = candidates.select("hash", "owner", "repository").distinct()
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    held = stage(by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")), "secret_owners")

    judged = candidates.drop("repository", "owner").join(held, "hash")
    copied = (F.col("owners") >= copied_owners) | (F.col("repositories") >= copied_repositories)
    return found, judged.withColumn("copied", copied).withColumn("owned", ~F.col("copied") & (F.col("kind") == 3)).drop("owners")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
