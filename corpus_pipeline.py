"""A corpus pipeline in five stages, each over all rows that the stage before it kept.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.llm import bpe, mixing, quality_rules, simhash, suffix_dedup
from paddock.llm.common import scratch, set_aside

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes of a repeated passage: fewer than 50 words of running text have (the shortest seen had 285).
PASSAGE = 240


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the compression bands."""
    judged = quality_rules.quality_rules(docs, "text", {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)})
    return judged.where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts whose sets of 5-word shingles have a Jaccard likeness of at least 0.8."""
    return simhash.one_of_each_group(docs, "doc_id", "text")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of PASSAGE bytes that start elsewhere too.

    A character that a cut splits goes altogether; n_chars is counted anew. Rows whose text becomes empty stay, with
    an empty text; null texts and texts without repeats stay as they are.
    """
    own, moved = set_aside(docs, *suffix_dedup.RESULTS)
    cut = suffix_dedup.without_repeats(own, "text", PASSAGE, whole=True)
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("kept").cast("string")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cut.select([F.col(f"`{moved.get(c, c)}`").alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, none to twice."""
    own, moved = set_aside(docs, *mixing.RESULTS)
    mixed = mixing.mix(own, "doc_id", "text", "source").where("copies > 0")
    taken = mixed.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select([F.col(f"`{moved.get(c, c)}`").alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of tokens, packed token ids, and whether decoding gives the text back."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), "text", RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "source",
        F.expr("cast(length(token_ids) div 4 as bigint)").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", keep_good_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: Fingerprints, suffix arrays and byte-pair merges are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "corpus")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
