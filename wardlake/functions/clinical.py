"""Clinical classification rules as column expressions."""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "age_group",
    "alert_flags",
    "heart_rate_points",
    "is_abnormal",
    "is_critical_result",
    "is_icu_admission",
    "lab_direction",
    "normal_gender",
    "plausible",
    "risk_level",
    "spo2_points",
]

# --- Fixed values: they decide results and must not be changed ---------------------
CRITICAL_TESTS = ("TROP", "ABG", "LACT", "K", "NA")
CRITICAL_FLAGS = ("H", "L")
ALERT_LIMITS = (
    # label, column, comparison, limit
    ("TACHYCARDIA", "heart_rate", ">", 130),
    ("BRADYCARDIA", "heart_rate", "<", 50),
    ("CRITICAL_LOW_SPO2", "spo2", "<", 90),
    ("HYPERTENSIVE_CRISIS", "systolic_bp", ">", 180),
)
NO_ALERT = "NORMAL"
SPO2_STEPS = ((91, 3), (93, 2), (95, 1))  # at most -> points
SPO2_OTHERWISE = 0
HEART_RATE_STEPS = ((40, 3), (50, 1), (90, 0), (110, 1), (130, 2))  # at most -> points
HEART_RATE_OTHERWISE = 3
RISK_STEPS = ((5, "HIGH"), (3, "MEDIUM"))  # at least -> risk
RISK_OTHERWISE = "LOW"
VITAL_BOUNDS = {
    "systolic_bp": (60, 250),
    "diastolic_bp": (30, 150),
    "heart_rate": (30, 250),
    "spo2": (50, 100),
    "temperature": (90, 110),
}
AGE_STEPS = ((18, "PEDIATRIC"), (65, "ADULT"))  # years, less than -> group
AGE_OTHERWISE = "SENIOR"
GENDERS = {"M": "M", "MALE": "M", "F": "F", "FEMALE": "F"}
GENDER_OTHERWISE = "U"
DIRECTIONS = {"H": "HIGH", "L": "LOW"}
DIRECTION_OTHERWISE = "NORMAL"
# ----------------------------------------------------------------------------------


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _ladder(value: Column, steps: tuple, otherwise, holds=operator.le) -> Column:
    """What belongs to the first step whose limit holds ``value``; NULL falls through."""
    pairs = [F.when(holds(value, limit), F.lit(then)) for limit, then in steps]
    return F.coalesce(*pairs, F.lit(otherwise))


def _named(value: Column, names: dict[str, str], otherwise: str) -> Column:
    """The entry of an upper-cased value in a fixed table; NULL and others fall through."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(value)), F.lit(otherwise))


def alert_flags(heart_rate="heart_rate", spo2="spo2", systolic_bp="systolic_bp") -> Column:
    """Alert labels joined by ``|``, or NORMAL. A reading of 0 is a missing reading."""
    readings = {"heart_rate": heart_rate, "spo2": spo2, "systolic_bp": systolic_bp}
    labels = []
    for label, name, comparison, limit in ALERT_LIMITS:
        reading = _column(readings[name])
        beyond = reading > limit if comparison == ">" else reading < limit
        labels.append(F.when((reading != 0) & beyond, F.lit(label)))
    joined = F.concat_ws("|", *labels)  # skips NULLs
    return F.when(joined == "", F.lit(NO_ALERT)).otherwise(joined)


def is_icu_admission(event_type="event_type", ward="ward") -> Column:
    """Admission to a ward named ICU in any case. The event type is matched as sent;
    unknown values give FALSE."""
    matched = (_column(event_type) == "ADMIT") & F.upper(_column(ward)).contains("ICU")
    return F.coalesce(matched, F.lit(False))


def is_critical_result(test_code="test_code", abnormal_flag="abnormal_flag") -> Column:
    """Three-valued: a critical test without a flag is NULL, any other test FALSE."""
    return _column(test_code).isin(*CRITICAL_TESTS) & _column(abnormal_flag).isin(*CRITICAL_FLAGS)


def is_abnormal(abnormal_flag="abnormal_flag") -> Column:
    """Case-sensitive, NULL for an unflagged result."""
    return _column(abnormal_flag).isin(*CRITICAL_FLAGS)


def lab_direction(abnormal_flag="abnormal_flag") -> Column:
    """HIGH, LOW or NORMAL (also for NULL), whatever the case of the flag."""
    return _named(_column(abnormal_flag), DIRECTIONS, DIRECTION_OTHERWISE)


def normal_gender(gender="gender") -> Column:
    """M, F, or U for anything else."""
    return _named(_column(gender), GENDERS, GENDER_OTHERWISE)


def age_group(age_years="age_years") -> Column:
    """Of whole years; an unknown age counts as SENIOR."""
    return _ladder(_column(age_years), AGE_STEPS, AGE_OTHERWISE, operator.lt)


def spo2_points(spo2="spo2") -> Column:
    """Early-warning points of the oxygen saturation; a missing reading scores 0."""
    return _ladder(_column(spo2), SPO2_STEPS, SPO2_OTHERWISE).cast("int")


def heart_rate_points(heart_rate="heart_rate") -> Column:
    """Early-warning points of the heart rate; a missing reading scores 3."""
    return _ladder(_column(heart_rate), HEART_RATE_STEPS, HEART_RATE_OTHERWISE).cast("int")


def risk_level(score: Column | str) -> Column:
    return _ladder(_column(score), RISK_STEPS, RISK_OTHERWISE, operator.ge)


def plausible(name: str) -> Column:
    """The measure when inside its inclusive bounds, else NULL."""
    low, high = VITAL_BOUNDS[name]
    return F.when(F.col(name).between(low, high), F.col(name))
