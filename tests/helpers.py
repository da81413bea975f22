"""Shared fixtures: the five seed patients and their change records."""

import datetime as dt
import json

MICROS = 1_700_000_000_000_000  # 2023-11-14 22:13:20
DAY = 86_400_000_000

PATIENTS = [
    {"patient_id": 1, "mrn": "MRN-001", "first_name": "James", "date_of_birth": "-1756",
     "gender": "M", "ssn": "123-45-6789", "phone": "555-0101", "email": "a@b.c"},
    {"patient_id": 2, "mrn": "MRN-002", "date_of_birth": "1978-07-24", "gender": "Female"},
    {"patient_id": 3, "mrn": "MRN-003", "date_of_birth": "unknown", "gender": "X"},
    {"patient_id": 4, "mrn": "MRN-004", "date_of_birth": "2015-02-15", "gender": "f"},
    {"patient_id": 5, "mrn": "MRN-005", "gender": "male"},
]
EVENTS = [
    {"event_id": 1, "patient_id": 1, "event_type": "ADMIT", "ward": "Cardiology"},
    {"event_id": 2, "patient_id": 2, "event_type": "ADMIT", "ward": "ICU"},
    {"event_id": 3, "patient_id": 3, "event_type": "TRANSFER", "ward": "Med-Surg"},
    {"event_id": 4, "patient_id": 4, "event_type": "ADMIT", "ward": "Maternity"},
    {"event_id": 5, "patient_id": 5, "event_type": "admit", "ward": "ICU"},
]
LABS = [
    {"result_id": 1, "patient_id": 1, "test_code": "TROP", "test_name": "Troponin I", "result_value": "0.08", "unit": "ng/mL", "abnormal_flag": "H"},
    {"result_id": 2, "patient_id": 2, "test_code": "ABG", "test_name": "Blood Gas", "result_value": "7.31", "unit": "pH", "abnormal_flag": "L"},
    {"result_id": 3, "patient_id": 3, "test_code": "HBA1C", "test_name": "HbA1c", "result_value": "8.2", "unit": "%", "abnormal_flag": "H"},
    {"result_id": 4, "patient_id": 4, "test_code": "CBC", "test_name": "WBC Count", "result_value": "11.2", "unit": "K/uL", "abnormal_flag": "H"},
    {"result_id": 5, "patient_id": 5, "test_code": "BNP", "test_name": "BNP", "result_value": "POS", "unit": "pg/mL", "abnormal_flag": "H"},
]
VITALS = [
    {"vital_id": 1, "patient_id": 1, "heart_rate": 102, "systolic_bp": 158, "diastolic_bp": 95, "temperature": 98.6, "spo2": 96},
    {"vital_id": 2, "patient_id": 2, "heart_rate": 118, "systolic_bp": 90, "diastolic_bp": 60, "temperature": 101.2, "spo2": 88},
    {"vital_id": 3, "patient_id": 3, "heart_rate": 78, "systolic_bp": 130, "diastolic_bp": 82, "temperature": 98.8, "spo2": 99},
    {"vital_id": 4, "patient_id": 4, "heart_rate": 88, "systolic_bp": 120, "diastolic_bp": 78, "temperature": 98.4, "spo2": 99},
    {"vital_id": 5, "patient_id": 5, "heart_rate": 95, "systolic_bp": 142, "diastolic_bp": 90, "temperature": 99.1, "spo2": 97},
]
SEED = {"patients": PATIENTS, "adt_events": EVENTS, "lab_results": LABS, "vitals": VITALS}
SEED_DAY = "2023-11-15"


def record(table, value, offset, deleted="false", **extra):
    """One line of a landing file."""
    if isinstance(value, dict):
        body = {**value, "created_at": MICROS, "__deleted": deleted, **extra}
        if table == "adt_events":
            body["event_timestamp"] = MICROS
        value = json.dumps(body)
    return {
        "topic": f"ehr.public.{table}",
        "partition": 0,
        "offset": offset,
        "timestamp": "2024-01-01T00:00:00Z",
        "key": None,
        "value": value,
    }


def land(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    lines = "".join(json.dumps(r) + "\n" for r in records)
    (folder / f"{name}.json").write_text(lines)


def seed_records():
    return [
        record(table, row, offset)
        for table, rows in SEED.items()
        for offset, row in enumerate(rows)
    ]


def rows_by(df, key):
    return {row[key]: row for row in df.collect()}


NOON = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
