"""A corpus from raw documents to packed training sequences, in stages written one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import base, exact_dedup, language, ngram_join, packing, toxicity
from wardlake.session import run_folder, ship_package

#: A language with less than this share of a text's bytes is no decision.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts of no clear language go. Each row is decided by its own text, whether or not it
    has an id or shares it; null and empty texts go, whole texts of any length are read, no rows give none."""
    return language.of_a_language(docs, language.train(docs), LEAST_SCORE)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts predicted toxic go, each row by its own text, whether or not it has an id or shares it. No rows give none, and
    without labels every text gets the same score."""
    return toxicity.calm(docs, toxicity.train(docs, base.labels(spark, sf_dir)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty) one row stays: with the largest doc_id, an id before none, and of rows that repeat
    both any one. No rows give none; other columns stay as they are."""
    kept = exact_dedup.exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    held = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_sha"))
    rows = docs.withColumn("_text", sha).join(kept, held).drop("_id", "_sha")
    return rows.dropDuplicates(["doc_id", "_text"]).drop("_text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least doc_id stays. Rows that repeat a doc_id, or have none, are one
    document here: they stay or go together. No rows give none."""
    least = ngram_join.near_duplicates(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(least, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences: one row per piece. A null or empty text is its end id; rows without an id or with
    equal ids are packed like others; no rows give none."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("packing", pack),
]

#: The models of the first two stages have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = run_folder(spark)
    for name, stage in STAGES[:-1]:
        docs = base.written(stage(spark, docs, sf_dir), name, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
