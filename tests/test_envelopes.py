"""The streaming envelope reader against the JSON parser, and in a feed folder."""

import gzip
import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cvelake.plans import build
from cvelake.sources import envelopes, feeds

RUN = "2024-01-15 06:00:00"


def read(text, key="items", count_key="n"):
    """(items as parsed, outcome) of a text cut as Spark's reader cuts it."""
    e = envelopes.Envelope(key, count_key)
    pieces = text.split("{")
    found = [item for p in (pieces if pieces[-1] else pieces[:-1]) for item in e.feed(p)]
    return [json.loads(x) for x in found], e.end()


values = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='a"\\{}[],:\n é', max_size=6),
    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(alphabet='k"\\{}', max_size=3), c, max_size=3),
    max_leaves=12,
)


@settings(max_examples=300, deadline=None)
@given(st.lists(values, max_size=5), st.dictionaries(st.sampled_from(["a", "b", "n", "items2"]), values, max_size=3), st.booleans(), st.sampled_from([None, 1]))
def test_items_are_those_of_the_parser(items, other, first, indent):
    envelope = {"items": items, **other} if first else {**other, "items": items}
    got, (reason, n, declared) = read(json.dumps(envelope, indent=indent))
    assert (got, reason, n) == (items, None, len(items))
    assert declared == (other["n"] if type(other.get("n")) is int else None)


@settings(max_examples=300, deadline=None)
@given(st.lists(values, max_size=4), st.data())
def test_a_cut_or_changed_text_is_never_taken_for_another(items, data):
    text = json.dumps({"n": 1, "items": items})
    at = data.draw(st.integers(0, len(text) - 1))
    for broken in (text[:at], text[:at] + data.draw(st.sampled_from('{}[],:"x')) + text[at:]):
        got, (reason, n, _) = read(broken)
        try:
            whole = json.loads(broken, strict=False)
        except ValueError:
            assert reason is not None
            continue
        want = whole.get("items") if isinstance(whole, dict) else None
        if reason is None:
            assert got == want and n == len(want)
        else:
            assert not isinstance(want, list)


@pytest.mark.parametrize("text,reason", [
    ("", "invalid JSON"),
    ("[]", "invalid JSON"),
    ('{"items": {}}', "missing or non-list 'items'"),
    ('{"a": {"items": [1]}}', "missing or non-list 'items'"),
    ('{"items": [1,]}', "invalid JSON"),
    ('{"items": [1 2]}', "invalid JSON"),
    ('{"items": [}]}', "invalid JSON"),
    ('{"items": [1]} x', "invalid JSON"),
    ('{"items": [{"a": }]}', "invalid JSON"),
])
def test_reasons(text, reason):
    assert read(text)[1][0] == reason


def test_what_is_held_does_not_grow_with_the_file():
    e = envelopes.Envelope("items")
    e.feed("")
    e.feed('"items": [')
    most = 0
    for i in range(50_000):
        for piece in ('"a": "' + "x" * 50 + '", "b": ', f'"c": {i}' + "}}, "):
            e.feed(piece)
            most = max(most, e.size + len(e.outer))
    assert e.items == 50_000 and most < 500


def _items(n, seed):
    rng = random.Random(seed)
    return [{"cve": {"id": f"CVE-2024-{i:05d}", "note": "".join(rng.choice('ab"\\{}[]\n ') for _ in range(40))}} for i in range(n)]


def test_large_broken_and_split_files(spark, tmp):
    for kind in ("nvd", "kev", "epss"):
        os.makedirs(f"{tmp}/{kind}")
    doc = json.dumps({"CVE_data_numberOfCVEs": 3000, "CVE_Items": _items(3000, 1)}).encode()
    packed = gzip.compress(doc)
    with open(f"{tmp}/nvd/a_2024-01-01.json.gz", "wb") as f:
        f.write(packed)
    with open(f"{tmp}/nvd/b_2024-01-02.json.gz", "wb") as f:
        f.write(packed[: len(packed) // 2])  # cut off
    with open(f"{tmp}/nvd/c_2024-01-03.json.gz", "wb") as f:
        f.write(gzip.compress(doc[:-1]))  # the last bracket is missing
    with open(f"{tmp}/nvd/d_2024-01-04.json.gz", "wb") as f:
        f.write(b"not gzip")
    kev = [{"cveID": f"CVE-2024-{i:05d}", "notes": "{" * (i % 7) + "}"} for i in range(4000)]
    with open(f"{tmp}/kev/k_2024-01-01.json", "w") as f:
        json.dump({"vulnerabilities": kev}, f, indent=1)
    with open(f"{tmp}/epss/e_2024-01-01.csv", "w") as f:
        f.write("# x\ncve,epss,percentile\n" + "".join(f"CVE-2024-{i:05d},0.5,0.5\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # the plain files are read in several tasks
    try:
        nvd, outcomes = feeds.read_files(spark, f"{tmp}/nvd", "nvd", RUN)
        assert {r["source_file"] for r in nvd.select("source_file").distinct().collect()} == {"a_2024-01-01.json.gz"}
        assert [json.loads(r["raw_json"]) for r in nvd.orderBy("cve_id").collect()] == _items(3000, 1)
        assert {(r["file_path"][-20:-8], r["ok"], r["reason"], r["n_records"]) for r in outcomes.collect()} == {
            ("a_2024-01-01", True, None, 3000), ("b_2024-01-02", False, "invalid JSON", None),
            ("c_2024-01-03", False, "invalid JSON", None), ("d_2024-01-04", False, "unreadable", None)}
        got = feeds.read_kev(spark, f"{tmp}/kev", RUN).orderBy("cve_id").collect()
        assert [json.loads(r["raw_json"]) for r in got] == kev
        assert feeds.read_epss(spark, f"{tmp}/epss", RUN).count() == 4000
        build.ingest(spark, f"{tmp}/tables", tmp, RUN)
        noted = spark.read.parquet(f"{tmp}/tables/bronze/ingest_files")
        assert {(r["kind"], r["ok"], r["n_records"]) for r in noted.filter("ok").collect()} == {("nvd", True, 3000), ("kev", True, 4000), ("epss", True, 4000)}
        assert build.skipped_files(spark, f"{tmp}/tables", RUN).count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
