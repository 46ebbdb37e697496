"""Question parsing columns: tokens, CVE ids, keyword tests, date phrases.

Tokens are the runs of ``[a-z0-9_]`` in the lower-cased text, so every
keyword test is an exact token or token-sequence match (no engine-specific
word-boundary rules).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cvelake.functions.columns import CVE_ID_FIND

# Routing keyword lists.
COMPARISON_WORDS = ("compare", "comparison", "versus", "vs")
TREND_WORDS = ("recent", "new", "latest", "trending", "exploited")
TREND_PHRASES = ("this month", "this week")
TIER_WORDS = ("critical", "high", "medium", "low")
KEV_WORDS = ("kev", "exploited", "cisa")
KEV_PHRASES = ("known exploited",)
#: Days from year 1 to the year 2021: no date lies further back.
MOST_DAYS = 738_000


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9_]+", " "), " "), lambda t: t != "")


def padded(tok: Column) -> Column:
    """`` tok1 tok2 ... `` for phrase tests."""
    return F.concat(F.lit(" "), F.array_join(tok, " "), F.lit(" "))


def has_any_word(tok: Column, words) -> Column:
    return F.arrays_overlap(tok, F.array(*[F.lit(w) for w in words]))


def has_any_phrase(pad: Column, phrases) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | pad.contains(f" {p} ")
    return out


def cve_ids(text: Column) -> Column:
    """Distinct CVE ids in the text, upper-cased, sorted."""
    found = F.regexp_extract_all(text, F.lit(CVE_ID_FIND), 0)
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.upper(x))))


def last_n_days(pad: Column) -> Column:
    """The number in ``last N days``; numbers beyond all dates count as MOST_DAYS."""
    n = F.regexp_extract(pad, r" last ([0-9]+) days ", 1)
    days = F.least(F.coalesce(n.try_cast("bigint"), F.lit(MOST_DAYS)), F.lit(MOST_DAYS))
    return F.when(n != "", days.cast("int"))


def days_before(day: Column, days: Column) -> Column:
    """``days`` before ``day``, not before year 1."""
    return F.greatest(F.date_sub(day, days), F.lit("0001-01-01").cast("date"))


def word_key(text: Column) -> Column:
    """The words of a name, blank-joined: ``Hewlett-Packard`` and
    ``hewlett_packard`` are both ``hewlett packard``."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(word_key(text), " "), lambda w: w != "")


def word_runs(words: Column, longest: Column) -> Column:
    """Distinct runs of 1 to ``longest`` words, blank-joined. ``words`` has to be a
    column of its own (an expression would be evaluated anew for every run)."""
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(longest, F.lit(1))),
        lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))),
                              lambda i: F.array_join(F.slice(words, i, n), " ")),
    )
    return F.array_distinct(F.filter(F.flatten(runs), lambda r: r != ""))


def since_date(text: Column) -> Column:
    d = F.regexp_extract(F.lower(text), r"since ([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return F.try_to_date(F.when(d != "", d), "yyyy-MM-dd")
