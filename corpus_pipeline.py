"""From documents to token ids: rules, near-duplicates, repeated passages, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, minhash, mixing, rules_forest, suffix_dedup
from tidemark.llm.common import prepare, stored, table
from tidemark.llm.queries import rank_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest reject go."""
    prepare(spark, sf_dir)
    return rules_forest.keep_good(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the one with the smallest doc_id stays."""
    prepare(spark, sf_dir)
    return minhash.keep_one(docs)


# Bytes of a passage that is a repetition. 50 words of a text have 285 bytes or more in all test tables.
PASSAGE = 240


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of PASSAGE-byte strings that occur more than once go from the texts; n_chars follows."""
    prepare(spark, sf_dir)
    left = suffix_dedup.without_repeats(docs, length=PASSAGE)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows, or none."""
    prepare(spark, sf_dir)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and whether they decode to the text."""
    prepare(spark, sf_dir)
    path, pattern = rank_file()
    encoded = bpe.encode(docs, path, pattern, ["doc_id", "source"])
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

# The forest, the sketches and the merges have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
