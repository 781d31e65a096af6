"""From raw documents to token ids: language, near-duplicates, repeated passages, source weights, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the
columns of the documents; the last returns token ids. Any column may be null and tables may be
empty: what the stages then do is said by their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, language, mixing, passages, queries, simhash
from riskloom.llm.base import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return language.accepted_only(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints connect, the smallest doc_id stays."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A passage stays in the first document that has it; all documents stay."""
    return passages.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``, and the digest of the text that decoding the ids gives back."""
    out = bpe.encoded(docs, queries.vocabulary(), keep=("doc_id", "lang", "source"), back=True)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("source_mix", source_mix), ("tokens", tokens)]

#: SQL has no XXH64, no language models and no tokenizer; tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
