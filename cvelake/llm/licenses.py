"""License scan by diagonal voting, in DataFrame functions only.

Every text becomes words; the hash of every run of ``K`` words joins the hashes of
the templates' runs. A hit at word p of the text and word q of the template votes
for the diagonal p - q; votes are added up by diagonal, diagonals at most ``SHIFT``
apart are merged (a word more or less moves the rest of a license by one), and a
merged span counts if its hits cover enough of the template. A template of at most
``WHOLE_RUNS`` runs is a short notice, in which one other word may name another
license, and counts only if it stands whole. Hits are compared word by word, so
equal hashes of different words don't count.

Fixed phrases are found beside it, as words that stand consecutively.

The templates are a parameter of at most ``MOST_TEMPLATE_WORDS`` words in all, which
bounds what is broadcast. The one scan emits a row per document and one per hit; no
text is shuffled.

Defined results: a null or empty text has no words and no labels; repeated rows each
keep their own result; an empty table gives no rows; the columns of ``docs`` other
than the text are carried in a struct, so that their names can't clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvelake.llm.license_texts import TEXTS
from cvelake.session import stage

# Phrases and labels, and what stands between words.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Opening words of common licenses and notices, by label, then short notices.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "the apache license 2 0",
        "apache license version 2 0",
        "apache 2 0 license",
        "under apache 2 0",
        "spdx license identifier apache 2 0",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "under the gpl",
        "the gnu gpl",
        "under gnu gpl",
        "spdx license identifier gpl",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4 0",
        "creative commons attribution noncommercial 4 0 international license",
        "cc by nc",
        "creative commons attribution noncommercial",
        "creative commons attribution non commercial",
    ],
    "cc-by": [
        "licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution 4 0",
        "creative commons attribution license",
        "under cc by 4 0",
    ],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "under the mit license",
        "under an mit license",
        "under mit license",
        "of the mit license",
        "the mit license mit",
        "spdx license identifier mit",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "under the bsd license",
        "under a bsd license",
        "under bsd license",
        "of the bsd license",
        "clause bsd license",
        "bsd 2 clause",
        "bsd 3 clause",
    ],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license 2 0",
        "mozilla public license v 2 0",
        "mozilla public license version 2 0",
        "under mpl 2 0",
        "under the mpl 2 0",
        "spdx license identifier mpl 2 0",
    ],
}
#: The short notices, and the whole texts of short licenses.
TEMPLATES = {label: TEMPLATES.get(label, []) + TEXTS.get(label, []) for label in sorted({*TEMPLATES, *TEXTS})}
K = 3
SHIFT = 2
#: Share of a template's runs that a span must hold.
LEAST_SHARE = 0.6
#: One word changed in the middle breaks ``K`` runs, most of so short a template.
WHOLE_RUNS = 4
MOST_TEMPLATE_WORDS = 200_000


def words_of(text: Column) -> Column:
    """Lower-case words of a text. The Kelvin sign, the one character whose lower
    case is a letter of A-Z without being one, is kept apart."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(text, "K", "ĸ")), F.lit(WORD), F.lit(0))


def _places(words: Column, phrase: list[str], label: str) -> Column:
    """Where the words of a phrase stand consecutively."""
    at = F.filter(
        F.sequence(F.lit(0), F.size(words) - len(phrase)),
        lambda i: _all([F.get(words, i + j) == w for j, w in enumerate(phrase)]),
    )
    found = F.transform(at, lambda i: F.struct(i.alias("start"), (i + len(phrase)).alias("end"), F.lit(label).alias("label")))
    return F.when(F.size(words) >= len(phrase), found).otherwise(F.array().cast("array<struct<start:int,end:int,label:string>>"))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _template_runs(docs: DataFrame, templates: dict[str, list[str]], k: int) -> DataFrame:
    rows, total = [], 0
    for label, texts in templates.items():
        for n, text in enumerate(texts):
            words = re.findall(WORD, text.lower())
            total += len(words)
            if len(words) < k:
                raise ValueError(f"a template of {label} has fewer than {k} words")
            rows += [(label, f"{label}/{n}", q, len(words) - k + 1, words[q : q + k]) for q in range(len(words) - k + 1)]
    if total > MOST_TEMPLATE_WORDS:
        raise ValueError(f"the templates have {total} words; at most {MOST_TEMPLATE_WORDS} are broadcast")
    schema = "label string, template string, q int, runs int, run array<string>"
    runs = docs.sparkSession.createDataFrame(rows, schema)
    return F.broadcast(runs.withColumn("hash", F.xxhash64(*[F.get("run", F.lit(j)) for j in range(k)])))


def scan(
    docs: DataFrame,
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    k: int = K,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Columns: ``row`` (struct of the other columns of ``docs``), ``n_words``,
    ``base`` (start, end, label of each phrase place) and ``spans`` (start, end,
    label, share of each verified template span), positions in words."""
    carried = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lists = {tuple(p.split()): label for p, label in phrases.items()}
    # A cheap test first: most texts hold no phrase.
    likely = whole.rlike("(?i)" + "|".join(f"{GAP}+".join(map(re.escape, p)) for p in lists))
    places = F.concat(*[_places(F.col("words"), list(p), label) for p, label in lists.items()])
    none = F.array().cast("array<struct<start:int,end:int,label:string>>")
    n_runs = F.size("words") - (k - 1)
    runs = F.transform(F.sequence(F.lit(0), n_runs - 1), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(k)]))
    read = (
        docs.select(F.struct(*carried).alias("row"), words_of(whole).alias("words"), likely.alias("likely"))
        .withColumn("uid", F.monotonically_increasing_id())
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("base", F.when(F.col("likely"), places).otherwise(none))
        .withColumn("hashes", F.when(n_runs > 0, runs).otherwise(F.array().cast("array<bigint>")))
    )
    # Place -1 stands for the document itself, so that one scan gives both.
    at = read.select("uid", "row", "n_words", "base", "words", F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), "hashes")).alias("at", "hash"))
    hits = at.join(_template_runs(docs, templates, k), "hash", "left").filter(
        (F.col("at") == 0) | _all([F.get("run", F.lit(j)) == F.get("words", F.col("at") + (j - 1)) for j in range(k)])
    )
    is_doc = F.col("at") == 0
    kept = hits.select(
        "uid",
        *[F.when(is_doc, F.col(c)).alias(c) for c in ("row", "n_words", "base")],
        is_doc.alias("is_doc"),
        (F.col("at") - 1).alias("p"),
        "q",
        "runs",
        "label",
        "template",
    )
    kept = stage(kept, "license_hits")

    diagonals = (
        kept.filter("not is_doc")
        .groupBy("uid", "label", "template", "runs", (F.col("p") - F.col("q")).alias("diagonal"))
        .agg(F.collect_set("q").alias("q"), F.min("p").alias("start"), (F.max("p") + k).alias("end"))
    )
    order = Window.partitionBy("uid", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT, F.lit(True))
    merged = (
        diagonals.withColumn("new", new.cast("int"))
        .withColumn("group", F.sum("new").over(order))
        .groupBy("uid", "label", "template", "runs", "group")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("q")))).alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"))
        .withColumn("share", F.col("votes") / F.col("runs"))
        .filter((F.col("share") >= least_share) & ((F.col("runs") > WHOLE_RUNS) | (F.col("votes") == F.col("runs"))))
    )
    per_doc = merged.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label", "share"))).alias("spans"))
    empty = F.array().cast("array<struct<start:int,end:int,label:string,share:double>>")
    return (
        kept.filter("is_doc")
        .select("uid", "row", "n_words", "base")
        .join(per_doc, "uid", "left")
        .select("row", "n_words", "base", F.coalesce("spans", empty).alias("spans"))
    )
