"""The ten ready-made reports over the Gold marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of the bounded reports and the order of risk levels.
TOP_PATIENTS = 10
CENSUS_DAYS = 14
ALERTS_SHOWN = 20
QUALITY_DAYS = 30
RISK_ORDER = ("HIGH", "MEDIUM", "LOW")


def _mean(name: str, digits: int) -> Column:
    return F.round(F.avg(name), digits)


def _matching(condition: Column) -> Column:
    """Count of matching rows, NULL when there are none."""
    return F.sum(F.when(condition, 1))


def _events(event_type: str) -> Column:
    return F.sum(F.when(F.col("event_type") == event_type, F.col("event_count")).otherwise(0))


def population(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_patients"),
        _mean("age_years", 1).alias("avg_age"),
        _matching(F.col("gender") == "F").alias("female"),
        _matching(F.col("gender") == "M").alias("male"),
        _mean("total_encounters", 1).alias("avg_encounters"),
        F.sum("icu_admissions").alias("total_icu_admissions"),
        F.sum("critical_labs_90d").alias("total_critical_labs_90d"),
    )


def age_groups(summary: DataFrame) -> DataFrame:
    grouped = summary.groupBy("age_group").agg(
        F.count(F.lit(1)).alias("patient_count"),
        _mean("total_encounters", 1).alias("avg_encounters"),
        _mean("critical_labs_90d", 2).alias("avg_critical_labs"),
        F.sum("icu_admissions").alias("total_icu"),
    )
    return grouped.orderBy("age_group")


def top_critical(summary: DataFrame) -> DataFrame:
    columns = summary.select(
        "patient_id", "mrn_hash", "age_years", "gender", "age_group", "total_encounters",
        "icu_admissions", "abnormal_labs_90d", "critical_labs_90d", "latest_sbp",
        "latest_spo2", "latest_news2_risk",
    )
    return columns.orderBy(
        F.desc_nulls_last("critical_labs_90d"),
        F.desc_nulls_last("abnormal_labs_90d"),
        "patient_id",
    ).limit(TOP_PATIENTS)


def wards(encounters: DataFrame) -> DataFrame:
    admitted = encounters.filter(F.col("event_type") == "ADMIT")
    grouped = admitted.groupBy("ward").agg(
        F.count(F.lit(1)).alias("encounters"),
        F.sum(F.when(F.col("is_icu"), 1).otherwise(0)).alias("icu_count"),
        _mean("avg_sbp", 1).alias("avg_sbp"),
        _mean("min_spo2", 1).alias("avg_min_spo2"),
    )
    return grouped.orderBy(F.desc("encounters"), "ward")


def risk_distribution(encounters: DataFrame) -> DataFrame:
    known = encounters.filter(F.col("news2_risk").isNotNull())
    grouped = known.groupBy("news2_risk").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        _mean("avg_sbp", 1).alias("avg_sbp"),
        _mean("min_spo2", 1).alias("avg_min_spo2"),
        _mean("max_hr", 1).alias("avg_max_hr"),
    )
    ranks = F.array(*[F.lit(level) for level in RISK_ORDER])
    return grouped.orderBy(F.array_position(ranks, F.col("news2_risk")))


def census(daily: DataFrame) -> DataFrame:
    by_day = daily.groupBy("event_date").agg(
        _events("ADMIT").alias("admissions"),
        _events("DISCHARGE").alias("discharges"),
        _events("TRANSFER").alias("transfers"),
        F.sum("event_count").alias("total_events"),
    )
    return by_day.orderBy(F.desc_nulls_last("event_date")).limit(CENSUS_DAYS)


def busiest_wards(daily: DataFrame) -> DataFrame:
    by_ward = daily.groupBy("ward").agg(
        F.sum("event_count").alias("total_events"), _events("ADMIT").alias("admissions")
    )
    return by_ward.orderBy(F.desc("total_events"), "ward")


def alert_list(alerts: DataFrame) -> DataFrame:
    columns = alerts.select(
        "result_id", "mrn_hash", "age_years", "gender", "test_name", "test_code",
        "result_numeric", "unit", "abnormal_direction", "result_time",
    )
    return columns.orderBy(F.desc_nulls_last("result_time"), "result_id").limit(ALERTS_SHOWN)


def alerts_by_test(alerts: DataFrame) -> DataFrame:
    grouped = alerts.groupBy("test_name", "test_code").agg(
        F.count(F.lit(1)).alias("alert_count"),
        _matching(F.col("abnormal_direction") == "HIGH").alias("high_count"),
        _matching(F.col("abnormal_direction") == "LOW").alias("low_count"),
        _mean("result_numeric", 2).alias("avg_value"),
        _mean("age_years", 1).alias("avg_patient_age"),
    )
    return grouped.orderBy(F.desc("alert_count"), "test_code")


def quality_kpis(dashboard: DataFrame) -> DataFrame:
    columns = dashboard.select(
        "metric_date",
        "patient_count",
        "dq_complete_count",
        F.round("dq_completeness_pct", 1).alias("completeness_pct"),
        "lab_count",
        "abnormal_count",
        "critical_count",
        F.round("critical_rate_pct", 2).alias("critical_rate_pct"),
        "vital_count",
        "alert_count",
    )
    return columns.orderBy(F.desc_nulls_last("metric_date")).limit(QUALITY_DAYS)


# Report -> (mart it reads, function).
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "q1_population": ("patient_summary", population),
    "q2_age_groups": ("patient_summary", age_groups),
    "q3_top_critical": ("patient_summary", top_critical),
    "q4_wards": ("encounter_metrics", wards),
    "q5_risk_dist": ("encounter_metrics", risk_distribution),
    "q6_census_pivot": ("daily_census", census),
    "q7_busiest_wards": ("daily_census", busiest_wards),
    "q8_alert_list": ("critical_alerts", alert_list),
    "q9_alerts_by_test": ("critical_alerts", alerts_by_test),
    "q10_dq_kpis": ("quality_dashboard", quality_kpis),
}


@dataclass
class ReportRun:
    frames: dict[str, DataFrame] = field(default_factory=dict)
    problems: dict[str, str] = field(default_factory=dict)


def run_reports(
    read_mart: Callable[[str], DataFrame], marts: Iterable[str] | None = None
) -> ReportRun:
    """The reports of the named marts (all when None). An unknown name or a mart that
    cannot be read is recorded and does not stop the others."""
    known = list(dict.fromkeys(mart for mart, _ in REPORTS.values()))
    run = ReportRun()
    for mart in known if marts is None else marts:
        if mart not in known:
            run.problems[mart] = f"unknown mart; choose from {', '.join(known)}"
            continue
        try:
            frame = read_mart(mart)
            for name, (needs, report) in REPORTS.items():
                if needs == mart:
                    run.frames[name] = report(frame)
        except Exception as error:  # one broken mart must not hide the other reports
            run.problems[mart] = str(error)
    return run
