import zlib

import numpy as np
from pyspark.sql import functions as F

from cvelake.llm import langid as L
from cvelake.llm.queries import QUERIES
from helpers_llm import SF, doc_rows


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    network = L.Network(["a", "b", "c"], states=3)
    symbols = rng.integers(0, 6, (9, 7)).astype(np.uint8)
    labels = rng.integers(0, 3, 7)
    _, grads = network.gradients(symbols, labels)
    for name, w in network.weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) if name[0] != "w" or k == 0 else rng.integers(0, 6) for k, s in enumerate(w.shape))
            value, step = w[at], 1e-2
            w[at] = value + step
            high = network.gradients(symbols, labels)[0]
            w[at] = value - step
            low = network.gradients(symbols, labels)[0]
            w[at] = value
            assert abs((high - low) / (2 * step) - grads[name][at]) < 2e-3, (name, at)


def test_pooling_covers_every_byte():
    network = L.Network(["a", "b"], states=4)
    texts = [b"abc" * 100, b"x", b"hello world" * 6]
    symbols, counts = L.pieces_of(texts)
    assert counts.tolist() == [5, 1, 2]
    means = network.document_means(symbols, counts)
    assert np.allclose(means.sum(axis=1), 1, atol=1e-4)
    for i, t in enumerate(texts):  # alone or in a batch
        assert np.allclose(network.document_means(*L.pieces_of([t]))[0], means[i], atol=1e-4)
    longer = network.document_means(*L.pieces_of([texts[0] + b" zzz zzz" * 50]))[0]
    assert not np.allclose(longer, means[0], atol=1e-4)


def test_held_out_accuracy_of_the_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_language_network"](spark, SF).collect()}
    rows = doc_rows(spark)
    assert len(got) == len(rows)
    right = []
    for d in rows:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == d["lang"])
    assert np.mean(right) >= 0.9


def test_sample_is_bounded_and_skips_held_out(spark):
    rows = [(i, "text number %d" % i, "en" if i % 3 else "de") for i in range(200)] + [(None, "x", "en"), (300, None, "en"), (301, "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.sample(df, docs_per_label=7)
    assert len(got) == 14
    held = {f"text number {i}" for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert not held & {t for _, t in got}
    assert {label for label, _ in L.sample(df, docs_per_label=7, most_labels=1)} == {"en"}


def test_edges(spark):
    texts = [None, "", "123 !?", "the of and " * 20, "der die das " * 20, "é", "𝒳", "a" * 300000]
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in enumerate(texts)] + [(None, "the", 1.0, "x")], "doc_id long, text string, score double, lang string")
    nothing, lang, score = L.predict(df, None)
    assert {(r[lang], r[score]) for r in nothing.collect()} == {("und", 0.0)}
    network = L.fit([("en", "the of and " * 30), ("de", "der die das " * 30)] * 20, steps=120)
    found, lang, score = L.predict(df, network)
    assert found.columns == [*df.columns, lang, score] and score != "score"
    got = {r["doc_id"]: r[lang] for r in found.collect()}
    assert [got[i] for i in range(5)] == ["und", "und", "und", "en", "de"]
    assert {got[5], got[6], got[7], got[None]} <= {"en", "de"}
    assert L.predict(df.filter(F.lit(False)), network)[0].count() == 0
    assert L.fit([]) is None and L.fit([("en", "12")]) is None


def test_the_bound_of_a_table_counts_all_its_labelled_rows(spark):
    network = L.Network(["a", "b"])
    scores = [0.8] * 300 + [0.9] * 96 + [0.6] * 3 + [0.7]
    rows = [("x", "a", s) for s in scores] + [(None, "a", 0.5)] * 50 + [("x", "und", 0.0)] * 50
    found = spark.createDataFrame(rows, "lang string, lang_pred string, score double").repartition(3)
    # A hundredth are 4 of 400 rows: the fifth smallest score counts.
    assert abs(L.least_score_of(found, network, "lang_pred", "score") - (0.5 + 0.3 / 3)) < 1e-4
    assert L.least_score_of(found.filter("false"), network, "lang_pred", "score") == 0.5
