"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paddock.llm import alignment, bpe, collocations, embedding_dedup, lm_scoring, mixing, quality_model, quality_rules, secret_scan, simhash, statements, suffix_dedup, token_count, toxicity

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def bpe_digests(docs: DataFrame) -> DataFrame:
    tables = {"pieces": 300_000, "pairs": 500_000, "states": 200_000}  # some 350 MB a worker; no other stage shares it
    coded = bpe.round_trip(docs.select("doc_id", "text"), "text", RANKS, public_tokenizers.PATTERN, **tables)
    return coded.select(
        "doc_id",
        F.expr("cast(length(token_ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    counted = token_count.token_counts(docs, "text", TOKENIZER, {"doc_id": docs["doc_id"]})
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules.quality_rules(docs, "text", {"doc_id": docs["doc_id"]})


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    mixed = mixing.mix(docs, "doc_id", "text", "source")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), "doc_id", "text")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir), "doc_id", "text", PIECES)


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    digest = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), digest.alias("own_sha256"))
    found = suffix_dedup.repeats(docs, "text")
    found = found.select(F.lower(F.hex("sha")).alias("own_sha256"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(found, "own_sha256", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "own_sha256").alias("kept_sha256"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secret_scan.find_secrets(docs, "text", {"doc_id": docs["doc_id"]})
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_entropy")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    aligned = alignment.align(docs, "text", TOKENIZER, PIECES, {"doc_id": docs["doc_id"]})
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    table = alignment.written(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return alignment.with_agreement(table)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), "text", "lang")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # lies beside the package

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict:
    named = (
        op1_byte_bpe, op2_token_counts, op3_quality_rules, op4_embedding_dedup, op5_source_mix, op6_simhash,
        op7_lm_scores, op8_quality_model, op9_suffix_dedup, op10_toxicity, op11_secret_scan, op12_token_alignment, op13_collocations, pipeline,
    )
    return {q.__name__: q for q in named}


def llm_statements() -> dict[str, str]:
    """DuckDB statements of the queries that SQL can express."""
    return {
        "op4_embedding_dedup": f"""with recursive v as (select vec_id, embedding::double[] as e from embeddings),
          l as (select a.vec_id as x, b.vec_id as y, list_cosine_similarity(a.e, b.e) as c from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
          near as (select x, y from l where not isnan(c) and c >= {embedding_dedup.THRESHOLD}::double),
          reach as (select vec_id as x, vec_id as y from v union select reach.x, near.y from reach join near on near.x = reach.y),
          least as (select x as vec_id, min(y) as component_id from reach group by 1),
          linked as (select x as vec_id, count(*) as n_links from near group by 1)
          select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept from least left join linked using (vec_id)""",
        "op11_secret_scan": statements.secret_scan_statement(),
        "op13_collocations": statements.collocations_statement(),
    }
