"""Answers to the sample questions of the described layer, as fixed queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.functions import temporal
from wardlake.operators.joins import join_unique

# Fixed values of the questions.
WEEK_DAYS = 7
LOW_SPO2 = 92
SENIOR_AGE = 60


def icu_patients(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("icu_admissions") > 0)


def critical_patients(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("critical_labs_90d") > 0)


def admissions_week(daily: DataFrame, as_of: temporal.AsOf = None) -> DataFrame:
    """Admissions per ward in the last seven days."""
    since = F.date_sub(temporal.as_date(as_of), WEEK_DAYS)
    recent = daily.filter((F.col("event_type") == "ADMIT") & (F.col("event_date") >= since))
    return recent.groupBy("ward").agg(F.sum("event_count").alias("admissions"))


def high_risk_low_spo2(summary: DataFrame) -> DataFrame:
    return summary.filter(
        (F.col("latest_news2_risk") == "HIGH") & (F.col("latest_spo2") < LOW_SPO2)
    )


def risk_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("latest_news2_risk").agg(F.count(F.lit(1)).alias("patient_count"))


def women_over_60(summary: DataFrame) -> DataFrame:
    return summary.filter((F.col("gender") == "F") & (F.col("age_years") > SENIOR_AGE))


def notes_with_patients(notes: DataFrame, summary: DataFrame) -> DataFrame:
    """Notes beside the summary of their patient."""
    return join_unique(notes, summary, "patient_id", how="inner")


def note_search(notes: DataFrame, summary: DataFrame, keyword: str) -> DataFrame:
    """Notes containing the keyword in any case, with their patients. The search runs
    before the join, so only matching notes are shuffled."""
    found = notes.filter(F.contains(F.lower("note_text"), F.lit(keyword.lower())))
    return notes_with_patients(found, summary)


def notes_by_author(notes: DataFrame, top: int = 1) -> DataFrame:
    """The authors of most notes."""
    counted = notes.groupBy("authored_by").agg(F.count(F.lit(1)).alias("note_count"))
    return counted.orderBy(F.desc("note_count"), "authored_by").limit(top)
