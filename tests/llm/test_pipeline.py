import re

import corpus_pipeline
from cvelake.llm import decontaminate, langid
from helpers_llm import SF, crc, documents, link_groups, reference_ids
from test_secrets import base


def redacted(text):
    out, at = "", 0
    for start, _, end in base(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secret_spans", "sequences"]


def test_run_matches_a_plain_version(spark):
    docs = documents(spark)
    rows = langid.sample(docs)
    network = langid.fit(rows)
    least = langid.least_score(network, rows)
    kept = []
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        data = langid.letters_of(r["text"])
        if data and network.document_means(*langid.pieces_of([data]))[0].max() >= least:
            kept.append((r["doc_id"], r["text"]))
    groups = link_groups(kept)
    kept = [(i, t) for i, t in kept if groups[i] == i]
    bench = [decontaminate.normalize(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    budget = decontaminate.budget_of
    near = lambda item, text: decontaminate.nearest(decontaminate.masks(item), len(item), text, 0)[0] <= budget(item)
    clean = []
    for i, t in kept:
        text = decontaminate.normalize(t)
        grams = {text[k : k + 8] for k in range(len(text) - 7)}
        if not any(any(item[k : k + 8] in grams for k in range(0, len(item) - 7, 4)) and near(item, text) for item in bench):
            clean.append((i, redacted(t)))
    want = []
    for i, t in clean:
        ids = [*reference_ids("word_bpe_49k.json", t), 1]
        want += [(i, n, s, len(ids[s : s + 4096]), crc(ids[s : s + 4096])) for n, s in enumerate(range(0, len(ids), 4096))]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert any(re.search(r"\[SECRET\]", t) for _, t in clean) or not any(base(t) for _, t in kept)


def test_stages_keep_the_columns_and_survive_odd_rows(spark):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "12 34", None, None, None), (3, "the and of " * 9, "en", "s", 9), (3, "the and of " * 9, "en", "s", 9)]
    docs = spark.createDataFrame(odd, documents(spark).schema)
    for df in (docs, docs.filter("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()


def test_noise_goes_and_clean_documents_stay(spark):
    import random

    rng = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*documents(spark).columns)
    noise = [(10**6 + i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(4000)), "en", "noise", 4000) for i in range(60)]
    whole = docs.unionAll(spark.createDataFrame(noise, docs.schema))
    rows = langid.sample(docs)
    network = langid.fit(rows)
    least = langid.least_score(network, rows)
    found, _, score = langid.predict(whole, network)
    scores = {r["doc_id"]: r[score] for r in found.collect()}
    clean = [s for i, s in scores.items() if i < 10**6]
    # Texts of a few letters aside, all documents of the table have a language.
    assert sum(s >= least for s in clean) >= 0.998 * len(clean)
    assert sum(scores[i] < least for i, *_ in noise) >= 40  # most of 60
    assert 1 / len(network.labels) < least < 1


def test_the_bound_follows_the_number_of_labels():
    rows = [(label, f"{word} " * 30) for label, word in zip("abcdefgh", ["banana", "kiwi", "plum", "fig", "oxyz", "quince", "melon", "grape"], strict=True)]
    for n in (2, 8):
        network = langid.fit(rows[:n], steps=60)
        assert 1 / n < langid.least_score(network, rows[:n]) < 1
