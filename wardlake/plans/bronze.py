"""Bronze: masked and enriched change rows, one function per source table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import clinical, mask_pii
from wardlake.operators.merge import OP, live_rows
from wardlake.schemas import SOURCE_TABLES

# Personal columns and the digest column that replaces them (None: dropped outright).
PERSONAL = {
    "ssn": "ssn_masked",
    "phone": "phone_masked",
    "email": "email_masked",
    "address": None,
    "first_name": None,
    "last_name": None,
}


def _stamp(df: DataFrame, table: str, at: Column | None) -> DataFrame:
    pipeline_ts = F.current_timestamp() if at is None else at
    return df.withColumns({"pipeline_ts": pipeline_ts, "source_table": F.lit(table)})


def bronze_patients(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Digests in place of personal data. The record number stays until Silver has
    hashed it with its own digest."""
    digests = {"mrn_hash": mask_pii("mrn")}
    digests |= {masked: mask_pii(raw) for raw, masked in PERSONAL.items() if masked}
    return _stamp(df.withColumns(digests).drop(*PERSONAL), "patients", at)


def bronze_adt(df: DataFrame, at: Column | None = None) -> DataFrame:
    return _stamp(df.withColumn("is_icu", clinical.is_icu_admission()), "adt_events", at)


def bronze_labs(df: DataFrame, at: Column | None = None) -> DataFrame:
    enriched = df.withColumns(
        {
            "result_numeric": F.col("result_value").try_cast("double"),
            "is_critical": clinical.is_critical_result(),
        }
    )
    return _stamp(enriched, "lab_results", at)


def bronze_vitals(df: DataFrame, at: Column | None = None) -> DataFrame:
    flagged = df.withColumn("alert_flags", clinical.alert_flags())
    flagged = flagged.withColumn("has_alerts", F.col("alert_flags") != clinical.NO_ALERT)
    return _stamp(flagged, "vitals", at)


# What a rule adds that Silver goes on with.
ADDED = {
    "patients": (),
    "adt_events": ("is_icu",),
    "lab_results": ("result_numeric", "is_critical"),
    "vitals": ("alert_flags", "has_alerts"),
}
BRONZE_RULES = {
    "patients": bronze_patients,
    "adt_events": bronze_adt,
    "lab_results": bronze_labs,
    "vitals": bronze_vitals,
}


def keyed_changes(df: DataFrame, key: str) -> DataFrame:
    """Without tombstones and unreadable records, which carry no key."""
    return df.filter(F.col(key).isNotNull())


def live_changes(df: DataFrame) -> DataFrame:
    """The view without deletes and without rows that belong to no patient."""
    return live_rows(df).filter(F.col("patient_id").isNotNull()).drop(OP)


def to_bronze(parsed: DataFrame, table: str, at: Column | None = None) -> DataFrame:
    return BRONZE_RULES[table](keyed_changes(parsed, SOURCE_TABLES[table].key), at)


def peek_patients(bronze: DataFrame, rows: int = 10) -> DataFrame:
    """A look at the first Bronze patients."""
    sample = bronze.select("patient_id", "mrn_hash", "gender", "pipeline_ts")
    return sample.orderBy("patient_id", "pipeline_ts").limit(rows)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
