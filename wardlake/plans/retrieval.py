"""Note retrieval: texts, vectors, nearest notes, and the context lines of an answer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.operators.balls import BallIndex
from wardlake.operators.vectors import SCORE_DIGITS, TOP_K, cosine_topk

# Fixed value: characters of a note that an answer cites.
PREVIEW_CHARS = 200
# Length of the vectors of hashed words.
DIMS = 256


def _shown(value: Column | str) -> Column:
    """A value as text, with a missing one spelled out."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit("None"))


def note_text(notes: DataFrame) -> DataFrame:
    """The text a note is embedded as: who, what kind, by whom, and the note."""
    text = F.concat(
        F.lit("Patient "), _shown("patient_id"),
        F.lit(" | "), _shown("note_type"),
        F.lit(" by "), _shown("authored_by"),
        F.lit(": "), _shown("note_text"),
    )
    return notes.withColumn("embed_text", text)


def _counts(texts: DataFrame, key: str, column: str, dims: int) -> DataFrame:
    """How often the words of a text fall into each of ``dims`` buckets: (key, bucket, n)."""
    words = F.explode(F.array_remove(F.split(F.lower(column), r"\s+"), ""))
    number = F.conv(F.substring(F.md5("_word"), 1, 8), 16, 10).cast("bigint")
    bucket = F.pmod(number, F.lit(dims)).cast("int").alias("bucket")
    return texts.select(key, words.alias("_word")).groupBy(key, bucket).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Embedder:
    """Weights of the buckets (bucket, weight): at most ``dims`` rows."""

    weights: DataFrame
    dims: int


def fit_embedder(texts: DataFrame, column: str = "embed_text", dims: int = DIMS, key: str = "note_id") -> Embedder:
    """Smoothed inverse document frequencies of hashed words. Any other source of a vector column can
    be used instead: retrieval needs nothing else."""
    counts = _counts(texts, key, column, dims)
    total = texts.agg(F.count(F.lit(1)).alias("total"))
    seen = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("seen"))
    weight = F.log((F.col("total") + 1) / (F.col("seen") + 1)) + 1
    # One row beside at most ``dims`` rows.
    return Embedder(seen.join(F.broadcast(total)).select("bucket", weight.alias("weight")), dims)


def bucket_weights(model: Embedder, texts: DataFrame, column: str = "embed_text", key: str = "note_id") -> DataFrame:
    """(key, bucket, value) of the texts' vectors, whose length is 1; zeros are left out. Buckets
    that no fitted text had weigh nothing."""
    counts = _counts(texts, key, column, model.dims)
    weighted = counts.join(F.broadcast(model.weights), "bucket").select(
        key, "bucket", (F.col("n") * F.col("weight")).alias("value")
    )
    entries = weighted.groupBy(key).agg(
        F.collect_list(F.struct("bucket", "value")).alias("entries"), F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm")
    )
    return entries.select(key, "norm", F.inline("entries")).select(key, "bucket", (F.col("value") / F.col("norm")).alias("value"))


def embed(model: Embedder, texts: DataFrame, column: str = "embed_text", key: str = "note_id") -> DataFrame:
    """The texts with an ``embedding`` array column of unit length, or zeros without a known word.
    Store it: a search then only multiplies."""
    values = bucket_weights(model, texts, column, key).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "value"))).alias("_values")
    )
    at = F.sequence(F.lit(0), F.lit(model.dims - 1))
    vector = F.transform(at, lambda i: F.coalesce(F.try_element_at("_values", i), F.lit(0.0)))
    return texts.join(values, key, "left").withColumn("embedding", vector.cast("array<float>")).drop("_values")


def retrieve(
    corpus: DataFrame,
    asked: DataFrame,
    model: Embedder,
    summary: DataFrame,
    alerts: DataFrame,
    folder: str,
    k: int = TOP_K,
    index: BallIndex | None = None,
) -> dict[str, DataFrame]:
    """From questions (query_id, embed_text) to hits, patients, notes used and both contexts.

    ``corpus`` are notes with stored vectors, and ``index`` the cells of these vectors; without it all of them are
    compared, with the same hits. The hits are written once below ``folder``, since every part of an answer starts
    from them.
    """
    spark = corpus.sparkSession
    vectors = embed(model, asked, key="query_id")
    hits = index.search(vectors, f"{folder}/asked", k).hits if index else cosine_topk(corpus, vectors, k)
    found = hit_notes(hits, corpus.drop("embedding"))
    found.write.mode("overwrite").parquet(f"{folder}/hits")
    found = spark.read.schema(found.schema).parquet(f"{folder}/hits")
    people = hit_patients(found)
    return {
        "hits": found.select("query_id", "place", "note_id", "score"),
        "patients": people,
        "notes": notes_used(found),
        "note_context": note_context(found),
        "structured_context": structured_context(people, summary, alerts),
    }


def hit_notes(hits: DataFrame, notes: DataFrame) -> DataFrame:
    """The notes found per question, with their place and the rounded similarity."""
    place = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("note_id"))
    )
    ranked = hits.withColumn("place", place)
    found = notes.join(ranked, "note_id")
    return found.withColumn("score", F.round("score", SCORE_DIGITS))


def hit_patients(found: DataFrame) -> DataFrame:
    """Patients of the notes found per question."""
    return found.select("query_id", "patient_id").distinct()


def notes_used(found: DataFrame) -> DataFrame:
    """What an answer cites: the start of each note and where it came from."""
    preview = F.concat(F.substring("note_text", 1, PREVIEW_CHARS), F.lit("..."))
    return found.select(
        "query_id", "place", "patient_id", "note_type", "authored_by", "score",
        preview.alias("text"),
    )


def note_context(found: DataFrame) -> DataFrame:
    """One text per question holding its notes in order (k of them)."""
    when = F.date_format("authored_at", "yyyy-MM-dd HH:mm")
    block = F.concat(
        F.lit("[Patient "), _shown("patient_id"),
        F.lit(" | "), _shown("note_type"),
        F.lit(" by "), _shown("authored_by"),
        F.lit(" | similarity="), _shown("score"),
        F.lit(" | "), _shown(when),
        F.lit("]\n"), _shown("note_text"),
    )
    blocks = found.select("query_id", F.struct("place", block.alias("block")).alias("_block"))
    ordered = F.sort_array(F.collect_list("_block")).getField("block")
    return blocks.groupBy("query_id").agg(F.array_join(ordered, "\n\n").alias("context"))


# The sections, and the wording of the lines below, which readers of an answer parse.
STRUCTURED, ALERTS = "STRUCTURED DATA", "CRITICAL ALERTS"


def structured_context(
    patients: DataFrame, summary: DataFrame, alerts: DataFrame
) -> DataFrame:
    """One line per summary row and per alert of the given patients.

    Lines stay rows: a patient may have any number of alerts, and a reader sorts by
    section and key. ``patients`` holds the ids found by a search; it is read twice, so it
    should be stored.
    """
    ids = patients.select("patient_id").distinct()
    of_patient = F.concat(F.lit("  Patient "), _shown("patient_id"), F.lit(": "))
    about = F.concat(
        of_patient,
        F.lit("age="), _shown("age_years"),
        F.lit(" gender="), _shown("gender"),
        F.lit(" NEWS2="), _shown("latest_news2_risk"),
        F.lit(" SpO2="), _shown("latest_spo2"), F.lit("%"),
        F.lit(" HR="), _shown("latest_hr"), F.lit("bpm"),
        F.lit(" SBP="), _shown("latest_sbp"), F.lit("mmHg"),
        F.lit(" ICU="), _shown("icu_admissions"),
        F.lit(" critical_labs="), _shown("critical_labs_90d"),
    )
    alert = F.concat(
        of_patient,
        _shown("test_name"), F.lit(" = "), _shown("result_numeric"),
        F.lit(" "), _shown("unit"),
        F.lit(" ("), _shown("abnormal_direction"), F.lit(")"),
    )
    summaries = summary.join(ids, "patient_id", "left_semi").select(
        F.lit(STRUCTURED).alias("section"),
        "patient_id",
        F.lit(None).cast("bigint").alias("result_id"),
        about.alias("line"),
    )
    alert_lines = alerts.join(ids, "patient_id", "left_semi").select(
        F.lit(ALERTS).alias("section"),
        "patient_id",
        F.col("result_id").cast("bigint").alias("result_id"),
        alert.alias("line"),
    )
    return summaries.unionByName(alert_lines)


def section_counts(lines: DataFrame) -> DataFrame:
    """Lines and patients of each section of a context; a section without lines counts 0."""
    sections = lines.sparkSession.createDataFrame([(STRUCTURED,), (ALERTS,)], "section string")
    counts = lines.groupBy("section").agg(
        F.count(F.lit(1)).alias("line_count"), F.count_distinct("patient_id").alias("patient_count")
    )
    return sections.join(counts, "section", "left").fillna(0, ["line_count", "patient_count"])
