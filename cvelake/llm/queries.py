"""The driver-facing queries of this subpackage: each applies its operator, with
production parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.llm import ann, centroids, decontaminate, huffman, langid, licenses, merkle, ngram_join, oracle, packing, preferences, secrets, toxicity, url_rules
from cvelake.llm.common import table
from cvelake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE, WORD_END = "word_bpe_49k.json", 1
BYTE_BPE, BYTE_END = "byte_bpe_50k.json", 0


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found, column = decontaminate.matches(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    hits = F.col(column)
    shown = F.transform(hits, lambda m: F.concat_ws(":", m["item_id"], m["distance"], m["start"], m["end"]))
    return found.select(
        "doc_id",
        (F.size(hits) > 0).alias("contaminated"),
        F.size(hits).cast("long").alias("n_items"),
        F.array_min(hits["distance"]).alias("least_distance"),
        F.array_join(shown, ",").alias("items"),
    )


def op2_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a page are those of the document that its URL's path names."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    named = F.regexp_extract(url_rules.path_of(F.col("url")), "/([0-9]{1,18})(?:[./]|$)", 1)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    blocked = ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked")
    labelled = pages.withColumn("doc_id", named.try_cast("long")).join(labels, "doc_id").select("url", blocked)
    judged = url_rules.judge(pages, url_rules.mine(labelled))
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "confidence", "mined_rule")


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    made = preferences.format_pairs(preferences.sibling_pairs(turns))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return made.withColumns({c: spans(c) for c in ("chosen_mask", "rejected_mask")})


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
        "most_repositories",
    )


def op5_language_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    network = langid.fit(langid.sample(docs))
    found, lang, score = langid.predict(docs.select("doc_id", "text"), network, ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def op6_cross_polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op7_huffman_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "huffman")
    huffman.write(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(BYTE_BPE), BYTE_END, out)
    return huffman.read(spark, out)


def op8_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    starts = F.transform("base", lambda b: b["start"].cast("long"))
    base_labels, labels = F.col("base.label"), F.concat(F.col("base.label"), F.col("spans.label"))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    best = F.coalesce(F.array_max(F.col("spans.share")), F.lit(0.0))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(labels).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))).alias("score"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), WORD_END)


def op10_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(F.coalesce(key % 2 == 0, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.verify(docs, tampered)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_naive_bayes_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    found, score = toxicity.score(docs, model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"))


def op13_threshold_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Query] = {
    "op1_pigeonhole_decontamination": op1_pigeonhole_decontamination,
    "op2_url_association_rules": op2_url_association_rules,
    "op4_preference_pairs": op4_preference_pairs,
    "op3_secret_ownership": op3_secret_ownership,
    "op5_language_network": op5_language_network,
    "op6_cross_polytope_search": op6_cross_polytope_search,
    "op7_huffman_token_ids": op7_huffman_token_ids,
    "op8_license_diagonals": op8_license_diagonals,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_prefix_tree_join": op10_prefix_tree_join,
    "op11_merkle_climb": op11_merkle_climb,
    "op12_naive_bayes_toxicity": op12_naive_bayes_toxicity,
    "op13_threshold_centroids": op13_threshold_centroids,
}
ORACLE_SQL: dict[str, str] = oracle.sql()
