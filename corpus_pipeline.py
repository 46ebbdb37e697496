"""The corpus pipeline: language ID, near-duplicate join, decontamination, secret
scan, packing. Every stage works on all that its predecessor kept, as it was written
and read again; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cvelake.llm import decontaminate, langid, ngram_join, packing, secrets
from cvelake.llm.common import table
from cvelake.llm.queries import WORD_BPE, WORD_END
from cvelake.session import stage

#: Chunks that a worker of the last stage remembers: the workers of all stages share
#: their executors' memory.
CACHE_CHUNKS = 100_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the network knows go: those without a letter,
    and those of which it is less sure than of nearly all labelled documents, a bound
    that is counted over the whole table."""
    network = langid.fit(langid.sample(docs))
    if network is None:
        return docs
    found, lang, score = langid.predict(docs, network)
    found = stage(found, "pipeline_scored")  # read twice
    least = langid.least_score_of(found, network, lang, score)
    return found.filter((F.col(lang) != "und") & (F.col(score) >= least)).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*[f"`{c}`" for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of training sequences."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), WORD_END, cache_chunks=CACHE_CHUNKS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_spans", secret_spans),
    ("sequences", sequences),
]
#: A trained network, tokens and packing are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
