"""Wire schemas of the source tables and the topic each one arrives on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TOPIC_PREFIX = "ehr.public."

# One row change as the broker delivers it (file landing zones use the same shape).
CHANGE_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

METRIC_ROW = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("entity", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("tag", T.StringType()),
    ]
)


_LONG, _INT, _DOUBLE, _TEXT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _wire(*fields: T.StructField) -> T.StructType:
    """The fields of a table, followed by the two change marks."""
    return T.StructType([*fields, T.StructField("__op", _TEXT), T.StructField("__deleted", _TEXT)])


@dataclass(frozen=True)
class SourceTable:
    """A replicated table: its merge key and the JSON shape of its changes.

    Keys are BIGINT: the source uses serial integers, but a change log of many
    facilities outgrows 32 bits and ``from_json`` would null the overflow.
    """

    name: str
    key: str
    wire: T.StructType

    @property
    def topic(self) -> str:
        return TOPIC_PREFIX + self.name


# The columns of the source tables on the wire.
PATIENTS = SourceTable(
    "patients",
    "patient_id",
    _wire(
        T.StructField("patient_id", _LONG),
        T.StructField("mrn", _TEXT),
        T.StructField("first_name", _TEXT),
        T.StructField("last_name", _TEXT),
        T.StructField("date_of_birth", _TEXT),
        T.StructField("gender", _TEXT),
        T.StructField("ssn", _TEXT),
        T.StructField("phone", _TEXT),
        T.StructField("email", _TEXT),
        T.StructField("address", _TEXT),
        T.StructField("insurance_id", _TEXT),
        T.StructField("created_at", _TEXT),
        T.StructField("updated_at", _TEXT),
    ),
)

ADT_EVENTS = SourceTable(
    "adt_events",
    "event_id",
    _wire(
        T.StructField("event_id", _LONG),
        T.StructField("patient_id", _LONG),
        T.StructField("event_type", _TEXT),
        T.StructField("event_timestamp", _LONG),
        T.StructField("facility_id", _TEXT),
        T.StructField("ward", _TEXT),
        T.StructField("bed_number", _TEXT),
        T.StructField("attending_doctor", _TEXT),
        T.StructField("reason", _TEXT),
        T.StructField("created_at", _LONG),
    ),
)

LAB_RESULTS = SourceTable(
    "lab_results",
    "result_id",
    _wire(
        T.StructField("result_id", _LONG),
        T.StructField("patient_id", _LONG),
        T.StructField("order_id", _TEXT),
        T.StructField("test_code", _TEXT),
        T.StructField("test_name", _TEXT),
        T.StructField("result_value", _TEXT),
        T.StructField("unit", _TEXT),
        T.StructField("reference_range", _TEXT),
        T.StructField("abnormal_flag", _TEXT),
        T.StructField("collected_at", _LONG),
        T.StructField("resulted_at", _LONG),
        T.StructField("ordering_provider", _TEXT),
        T.StructField("created_at", _LONG),
    ),
)

VITALS = SourceTable(
    "vitals",
    "vital_id",
    _wire(
        T.StructField("vital_id", _LONG),
        T.StructField("patient_id", _LONG),
        T.StructField("heart_rate", _INT),
        T.StructField("systolic_bp", _INT),
        T.StructField("diastolic_bp", _INT),
        T.StructField("temperature", _DOUBLE),
        T.StructField("spo2", _INT),
        T.StructField("respiratory_rate", _INT),
        T.StructField("recorded_at", _LONG),
        T.StructField("recorded_by", _TEXT),
        T.StructField("created_at", _LONG),
    ),
)

SOURCE_TABLES = {t.name: t for t in (PATIENTS, ADT_EVENTS, LAB_RESULTS, VITALS)}
TOPICS = {t.topic: t for t in SOURCE_TABLES.values()}


def union_schema() -> T.StructType:
    """One struct holding every column of every table, for a mixed topic stream.

    A column name used by two tables with different wire types is read as text.
    """
    merged: dict[str, T.DataType] = {}
    for table in SOURCE_TABLES.values():
        for field in table.wire.fields:
            known = merged.setdefault(field.name, field.dataType)
            if known != field.dataType:
                merged[field.name] = T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in merged.items()])
