import re

import pytest
from pyspark.sql import functions as F

from cvelake.llm import licenses
from cvelake.llm.queries import QUERIES
from helpers_llm import SF, doc_rows

PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(ASCII))


def places(words):
    return sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p)


def check(r, text):
    words = words_of(text)
    at = places(words)
    assert (r["n_words"], r["n_base"]) == (len(words), len(at))
    assert (r["first_word"], r["last_word"]) == ((at[0][0], at[-1][0]) if at else (None, None))
    assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
    assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert 0 <= r["score"] <= 1


def test_query_on_whole_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_license_diagonals"](spark, SF).collect()}
    rows = doc_rows(spark)
    assert len(got) == len(rows)
    for d in rows:
        check(got[d["doc_id"]], d["text"])
        line = "Licensed under the Apache License, Version 2.0." in d["text"]
        assert line == ("apache-2.0" in got[d["doc_id"]]["labels"].split(","))


def test_edges(spark):
    texts = [None, "", "CC  BY cc-by, cc by", "all rights\nRESERVED general public\tlicense", "cc", "é ñ CC BYK by", "x " * 30000 + "cc by"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(2, texts[2])], "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("label", F.lit("x"))
    found = licenses.scan(df)
    for r in found.collect():
        at = places(words_of(texts[r["row"]["doc_id"]]))
        assert [(b["start"], b["label"]) for b in sorted(r["base"], key=lambda b: b["start"])] == at
        assert r["n_words"] == len(words_of(texts[r["row"]["doc_id"]]))
    assert found.count() == len(texts) + 1
    assert licenses.scan(df.filter("false")).count() == 0


def test_diagonals_survive_added_and_missing_words(spark):
    bsd = licenses.TEMPLATES["bsd"][0].split()
    edited = bsd[:7] + ["truly"] + bsd[7:15] + bsd[16:]
    texts = [" ".join(["intro"] * 5 + edited), " ".join(bsd[:6]), " ".join(bsd + ["gap"] * 9 + bsd), "one two " + " ".join(reversed(bsd))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: [(s["start"], s["end"], s["label"]) for s in r["spans"]] for r in licenses.scan(df).collect()}
    n = len(bsd)
    assert got == {0: [(5, 5 + len(edited), "bsd")], 1: [], 2: [(0, n, "bsd"), (n + 9, 2 * n + 9, "bsd")], 3: []}


def test_template_bounds(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        licenses.scan(df, templates={"short": ["two words"]})
    monkeypatch.setattr(licenses, "MOST_TEMPLATE_WORDS", 3)
    with pytest.raises(ValueError):
        licenses.scan(df)


def test_every_license_line_of_the_table(spark):
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "All rights reserved.": "reserved",
        "Released under the MIT License.": "mit",
    }
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op8_license_diagonals"](spark, sf).select("doc_id", "labels", "score").collect()}
    seen = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        want = {label for line, label in lines.items() if line in (d["text"] or "")}
        seen |= want
        found = set(got[d["doc_id"]]["labels"].split(",")) - {""}
        assert found - {"cc-by"} == want  # the phrase "cc by" stands in the line of cc-by-nc, too
        assert (got[d["doc_id"]]["score"] > 0) == bool(want)
    assert seen == set(lines.values())


def test_short_notices(spark):
    texts = {
        "Released under the MIT License.": {"mit"},
        "It is licensed under the MIT license": {"mit"},
        "under the terms of the MIT License": {"mit"},
        "SPDX-License-Identifier: MIT": {"mit"},
        "Released under the Apache License 2.0": {"apache-2.0"},
        "Released under Apache-2.0": {"apache-2.0"},
        "Released under the GPL, v3": {"gpl"},
        "Released under the BSD License": {"bsd"},
        "the 3-clause BSD license": {"bsd"},
        "Released under the Mozilla Public License, version 2.0": {"mpl-2.0"},
        "Released under CC-BY-4.0": {"cc-by"},
        "Creative Commons Attribution 4.0": {"cc-by"},
        "Creative Commons Attribution-NonCommercial 4.0": {"cc-by-nc"},
        # Not these licenses, or none.
        "released under the MIT OpenCourseWare name": set(),
        "Released under the Mozilla Public License, version 1.1": set(),
        "Released under the General Public License, version 2.0": set(),
        "released under the license of the house": set(),
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["row"]["doc_id"]: {s["label"] for s in r["spans"]} for r in licenses.scan(df).collect()}
    assert got == dict(enumerate(texts.values()))


def test_whole_texts_are_found_through_edits(spark):
    """A few words changed, dropped and added in every whole text; the span is the text's."""
    import random

    from cvelake.llm.license_texts import TEXTS

    rng = random.Random(2)
    rows, want = [], {}
    for label, texts in TEXTS.items():
        for text in texts:
            words = words_of(text)
            for at in sorted(rng.sample(range(5, len(words) - 5), len(words) // 25), reverse=True):
                words[at : at + 1] = rng.choice([["other"], [], [words[at], "added"]])
            i = len(rows)
            rows.append((i, " ".join(["before"] * (7 + i) + words + ["after"] * 9)))
            want[i] = (label, 7 + i, 7 + i + len(words))
    got = {r["row"]["doc_id"]: r["spans"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, start, end) in want.items():
        assert {s["label"] for s in got[i]} == {label}
        widest = max(got[i], key=lambda s: s["end"] - s["start"])
        assert start <= widest["start"] <= start + 4 and end - 4 <= widest["end"] <= end and 0.6 <= widest["share"] < 1
