"""One query for each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import (
    base,
    byte_bpe,
    exact_dedup,
    hard_negatives,
    language,
    language_model,
    mixing,
    ngram_join,
    packing,
    perplexity,
    prefix_trie,
    quality_rules,
    token_shards,
    toxicity,
)
from wardlake.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(base.documents(spark, sf_dir))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.documents(spark, sf_dir)
    stream = exact_dedup.open_stream(spark, f"{sf_dir}/documents.parquet")
    return exact_dedup.exact_duplicates(docs, stream)


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(base.documents(spark, sf_dir))


@query
def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scores(base.documents(spark, sf_dir))


@query
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_folder(spark)}/shards"
    token_shards.write_shards(base.documents(spark, sf_dir), path)
    stored = token_shards.read_shards(spark, path)
    return (
        token_shards.read_documents(stored)
        .select("part", "shard", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
        .join(token_shards.first_places(stored), ["part", "shard"])
        .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
    )


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.decode(byte_bpe.encode(base.documents(spark, sf_dir))).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(base.documents(spark, sf_dir), base.labels(spark, sf_dir))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.apply_policy(quality_rules.ledger(base.documents(spark, sf_dir)))
    base_mask = sum(quality_rules.bit(name) for name in quality_rules.BASE_RULES)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(base_mask)) != 0).alias("base_failed"),
        "kept", "failed", "n_lines", "n_distinct_words", "n_upper",
    )


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(base.documents(spark, sf_dir), base.labels(spark, sf_dir))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(base.documents(spark, sf_dir))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0, label=label)


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("node", "parent")


@query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(base.documents(spark, sf_dir))


def registered() -> dict[str, Query]:
    return dict(QUERIES)
