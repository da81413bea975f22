"""Every rule at its boundaries, with NULLs, zeros and unreadable values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlake.functions import clinical, mask_pii, mrn_digest, temporal


def values(frame, schema, rows, column):
    df = frame([(i, *r) for i, r in enumerate(rows)], f"i INT, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_digests(frame):
    rows = [("123-45-6789",), ("",), (None,)]
    masked = values(frame, "v STRING", rows, mask_pii("v"))
    assert masked == ["01a54629efb95228", "e3b0c44298fc1c14", None]
    assert values(frame, "v STRING", [("MRN-001",)], mrn_digest("v")) == ["33e17aba51daa479"]


def test_alert_flags(frame):
    rows = [(0, 95, 100), (49, 95, 100), (50, 95, 100), (130, 95, 100), (131, 95, 100),
            (None, None, None), (80, 0, 100), (80, 89, 100), (80, 90, 100), (80, 95, 180),
            (80, 95, 181), (140, 80, 200)]
    found = values(frame, "heart_rate INT, spo2 INT, systolic_bp INT", rows, clinical.alert_flags())
    assert found == [
        "NORMAL", "BRADYCARDIA", "NORMAL", "NORMAL", "TACHYCARDIA", "NORMAL", "NORMAL",
        "CRITICAL_LOW_SPO2", "NORMAL", "NORMAL", "HYPERTENSIVE_CRISIS",
        "TACHYCARDIA|CRITICAL_LOW_SPO2|HYPERTENSIVE_CRISIS",
    ]


def test_icu_admission(frame):
    rows = [("ADMIT", "Neuro-icu"), ("admit", "ICU"), ("ADMIT", None), (None, "ICU"), ("TRANSFER", "ICU")]
    found = values(frame, "event_type STRING, ward STRING", rows, clinical.is_icu_admission())
    assert found == [True, False, False, False, False]


def test_critical_result_is_three_valued(frame):
    rows = [("TROP", "H"), ("K", "L"), ("TROP", "h"), ("TROP", None), ("CBC", None), ("CBC", "H"), (None, "H")]
    found = values(frame, "test_code STRING, abnormal_flag STRING", rows, clinical.is_critical_result())
    assert found == [True, True, False, None, False, False, None]


def test_lab_flags(frame):
    rows = [("H",), ("h",), ("L",), ("N",), (None,)]
    direction = values(frame, "abnormal_flag STRING", rows, clinical.lab_direction())
    assert direction == ["HIGH", "HIGH", "LOW", "NORMAL", "NORMAL"]
    abnormal = values(frame, "abnormal_flag STRING", rows, clinical.is_abnormal())
    assert abnormal == [True, False, True, False, None]


def test_gender(frame):
    rows = [("m",), ("Male",), ("F",), ("female",), ("X",), (None,)]
    assert values(frame, "gender STRING", rows, clinical.normal_gender()) == list("MMFFUU")


def test_age_group(frame):
    rows = [(17,), (18,), (64,), (65,), (None,)]
    found = values(frame, "age_years BIGINT", rows, clinical.age_group())
    assert found == ["PEDIATRIC", "ADULT", "ADULT", "SENIOR", "SENIOR"]


def test_spo2_points(frame):
    rows = [(91.0,), (92.0,), (93.0,), (94.0,), (95.0,), (96.0,), (None,)]
    assert values(frame, "spo2 DOUBLE", rows, clinical.spo2_points()) == [3, 2, 2, 1, 1, 0, 0]


def test_heart_rate_points(frame):
    rows = [(40,), (41,), (50,), (51,), (90,), (91,), (110,), (111,), (130,), (131,), (None,)]
    found = values(frame, "heart_rate INT", rows, clinical.heart_rate_points())
    assert found == [3, 1, 1, 0, 0, 1, 1, 2, 2, 3, 3]


def test_risk(frame):
    found = values(frame, "s INT", [(0,), (2,), (3,), (4,), (5,), (6,)], clinical.risk_level("s"))
    assert found == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


@pytest.mark.parametrize("name", clinical.VITAL_BOUNDS)
def test_bounds_are_inclusive(frame, name):
    low, high = clinical.VITAL_BOUNDS[name]
    rows = [(low - 1.0,), (float(low),), (float(high),), (high + 1.0,), (None,)]
    found = values(frame, f"{name} DOUBLE", rows, clinical.plausible(name))
    assert found == [None, float(low), float(high), None, None]


def test_birth_date(frame):
    rows = [("-1756",), ("1965-03-12",), ("unknown",), (None,), ("",)]
    born = dt.date(1965, 3, 12)
    assert values(frame, "v STRING", rows, temporal.birth_date("v")) == [born, born, None, None, None]


def test_age(frame):
    rows = [(dt.date(1965, 3, 12),), (dt.date(2001, 8, 2),), (None,)]
    column = temporal.age_in_years("d", "2001-08-01")
    assert values(frame, "d DATE", rows, column) == [36, -1, None]


def test_micros(frame):
    rows = [("1700000000123456",), ("soon",), (None,)]
    column = temporal.from_micros("v").cast("string")
    assert values(frame, "v STRING", rows, column) == ["2023-11-14 22:13:20.123456", None, None]


def test_cutoff_keeps_the_time_column_bare(spark):
    df = spark.range(1).select(temporal.days_before("2001-08-01", 90).alias("t"))
    assert df.first().t == dt.datetime(2001, 5, 3)
    assert spark.range(1).select(temporal.as_date(None) == F.current_date()).first()[0]
