"""The driver's tables in the shape of the source tables (rules of FIXTURES.md).

Every frame carries ``kafka_timestamp``, ``kafka_offset`` and ``pipeline_ts``, the version of a change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators.merge import live_rows
from wardlake.plans import bronze, gold, silver
from wardlake.schemas import SOURCE_TABLES
from wardlake.session import bound_scans, use_utc

AS_OF = "2001-08-01"
CENSUS_AS_OF = "2024-01-31"
QUERY_VECTORS = 5
# Patients were loaded on many days, of which some are days of results and readings.
LOADED = "cast(date_add(DATE'1997-01-01', cast(patient_id % 400 + kafka_offset as int)) as timestamp)"

PATIENTS = [
    "cast(c_custkey as int) AS patient_id",
    "c_name AS mrn",
    "'Given' || cast(c_custkey as string) AS first_name",
    "'Family' || cast(c_custkey as string) AS last_name",
    """CASE WHEN c_custkey % 41 = 40 THEN NULL WHEN c_custkey % 50 = 49 THEN 'unknown'
       WHEN c_custkey % 3 = 0 THEN cast((c_custkey * 37) % 20000 - 12000 as string)
       ELSE '19' || cast(30 + c_custkey % 70 as string) || '-06-15' END AS date_of_birth""",
    """CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'male'
       WHEN 3 THEN 'Female' WHEN 4 THEN 'X' END AS gender""",
    """'900-' || lpad(cast(c_custkey % 100 as string), 2, '0') || '-'
       || lpad(cast(c_custkey % 10000 as string), 4, '0') AS ssn""",
    """CASE WHEN c_custkey % 9 = 8 THEN NULL
       ELSE '555-' || lpad(cast(c_custkey % 10000 as string), 4, '0') END AS phone""",
    "lower(c_name) || '@example.com' AS email",
    "c_mktsegment AS address",
    """'INS-' || cast(100000 + c_custkey as string)
       || CASE WHEN ver = 1 THEN '' ELSE '-R' END AS insurance_id""",
    "CASE ver WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op",
    "ver",
]

EVENTS = [
    "cast(event_id as int) AS event_id",
    "cast(user_id as int) AS patient_id",
    """CASE event_type WHEN 'signup' THEN 'ADMIT' WHEN 'view' THEN 'ADMIT'
       WHEN 'purchase' THEN 'discharge' ELSE 'TRANSFER' END AS event_type""",
    "unix_micros(cast(ts as timestamp)) AS event_timestamp",
    "'FAC-00' || cast(1 + event_id % 3 as string) AS facility_id",
    """CASE event_id % 6 WHEN 0 THEN 'ICU' WHEN 1 THEN 'Cardiology' WHEN 2 THEN 'Med-Surg'
       WHEN 3 THEN 'Maternity' WHEN 4 THEN 'Neuro-icu' END AS ward""",
    "'BED-' || cast(100 + event_id % 40 as string) AS bed_number",
    "'Dr. ' || cast(event_id % 12 as string) AS attending_doctor",
    "props AS reason",
    "unix_micros(cast(ts as timestamp)) AS created_at",
]

LABS = [
    "cast(o_orderkey as int) AS result_id",
    "cast(o_custkey as int) AS patient_id",
    """CASE o_orderkey % 8 WHEN 0 THEN 'TROP' WHEN 1 THEN 'ABG' WHEN 2 THEN 'LACT'
       WHEN 3 THEN 'K' WHEN 4 THEN 'NA' WHEN 5 THEN 'HBA1C' WHEN 6 THEN 'CBC'
       ELSE 'BNP' END AS test_code""",
    "'Test ' || cast(o_orderkey % 8 as string) AS test_name",
    """CASE WHEN o_orderkey % 97 = 0 THEN 'POS' ELSE cast(o_custkey % 500 as string) || '.'
       || lpad(cast(o_orderkey % 100 as string), 2, '0') END AS result_value""",
    "CASE WHEN o_orderkey % 2 = 0 THEN 'ng/mL' ELSE 'pH' END AS unit",
    """CASE WHEN o_orderstatus = 'F' THEN 'H' WHEN o_orderstatus = 'O' THEN 'L'
       WHEN o_orderkey % 3 = 0 THEN 'N' WHEN o_orderkey % 3 = 1 THEN 'h' END AS abnormal_flag""",
    # Collected 1 to 200 minutes before the result, which is known for most orders.
    """unix_micros(cast(o_orderdate as timestamp))
       - (1 + o_orderkey % 200) * 60000000 AS collected_at""",
    """CASE WHEN o_orderkey % 11 <> 10 THEN unix_micros(cast(o_orderdate as timestamp)) END
       AS resulted_at""",
    "unix_micros(cast(o_orderdate as timestamp)) AS created_at",
]

VITALS = [
    "l_orderkey * 8 + l_linenumber AS vital_id",
    "cast(l_partkey % 200 as int) AS patient_id",
    """CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 0
       ELSE cast(35 + (l_orderkey * 7 + l_linenumber) % 120 as int) END AS heart_rate""",
    "cast(70 + (l_orderkey * 3) % 200 as int) AS systolic_bp",
    "cast(25 + (l_suppkey * 11 + l_orderkey) % 140 as int) AS diastolic_bp",
    """CASE WHEN l_partkey % 29 = 0 THEN NULL
       ELSE cast(80 + (l_orderkey + l_partkey) % 22 as int) END AS spo2""",
    "cast(880 + l_orderkey % 240 as double) / 10 AS temperature",
    "unix_micros(cast(l_shipdate as timestamp)) AS created_at",
    "cast(round(l_extendedprice * 100) as bigint) AS tie",
]

NOTES = [
    "cast(doc_id as int) AS note_id",
    "cast(doc_id % 150 as int) AS patient_id",
    """CASE doc_id % 4 WHEN 0 THEN 'ADMISSION' WHEN 1 THEN 'PROGRESS' WHEN 2 THEN 'NURSING'
       ELSE 'DISCHARGE' END AS note_type""",
    "source AS authored_by",
    "timestamp_micros(1704067200000000 + doc_id * 60000000) AS authored_at",
    "text AS note_text",
]


class Lazy(Mapping):
    """Named frames, each built when first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names, self._build, self._made = list(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._build(name)
        return self._made[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Tables:
    """All adapters and layers of one data folder, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = bound_scans(use_utc(spark))
        self.folder = folder
        self.at = F.lit(AS_OF).cast("timestamp")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Source rows -------------------------------------------------------------------
    @cached_property
    def patients_cdc(self) -> DataFrame:
        versions = F.expr(
            """explode(array_compact(array(1, CASE WHEN c_custkey % 4 = 0 THEN 2 END,
               CASE WHEN c_custkey % 10 = 0 THEN 3 END)))"""
        )
        versioned = self.raw("customer").withColumn("ver", versions)
        return versioned.selectExpr(*PATIENTS).withColumns(
            {
                "kafka_timestamp": F.lit(AS_OF).cast("timestamp"),
                "pipeline_ts": F.col("ver"), "kafka_offset": F.col("ver"), "cdc_op": F.col("op"),
            }
        )

    @cached_property
    def adt_raw(self) -> DataFrame:
        rows = self.raw("events").selectExpr(*EVENTS)
        return _versioned(rows, "created_at", "event_id")

    @cached_property
    def labs_raw(self) -> DataFrame:
        rows = self.raw("orders").selectExpr(*LABS)
        return _versioned(rows, "created_at", "result_id")

    @cached_property
    def vitals_raw(self) -> DataFrame:
        rows = self.raw("lineitem").selectExpr(*VITALS)
        return _versioned(rows, "created_at", "tie")

    @cached_property
    def notes(self) -> DataFrame:
        return self.raw("documents").selectExpr(*NOTES)

    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select("vec_id", "embedding")

    # Layers ------------------------------------------------------------------------
    @cached_property
    def bronze(self) -> Lazy:
        sources = {
            "patients": lambda: self.patients_cdc,
            "adt_events": lambda: self.adt_raw,
            "lab_results": lambda: self.labs_raw,
            "vitals": lambda: self.vitals_raw,
        }
        arrived = F.col("pipeline_ts")
        return Lazy(sources, lambda n: bronze.BRONZE_RULES[n](sources[n](), arrived))

    @cached_property
    def silver_versions(self) -> Lazy:
        """Newest version per key, delete markers included."""
        loaded = {"patients": F.expr(LOADED)}
        return Lazy(
            SOURCE_TABLES,
            lambda n: silver.build_silver(n, self.bronze[n], AS_OF, loaded.get(n, self.at)),
        )

    @cached_property
    def silver(self) -> Lazy:
        return Lazy(SOURCE_TABLES, lambda n: live_rows(self.silver_versions[n]))

    @cached_property
    def marts(self) -> Lazy:
        return Lazy(gold.MARTS, lambda n: gold.build_mart(n, self.silver, AS_OF, self.at))

    def mart(self, name: str) -> DataFrame:
        """A mart without its wall-clock column."""
        return self.marts[name].drop("gold_computed_at", "alert_generated_at")


def _versioned(rows: DataFrame, at: str, tie: str) -> DataFrame:
    return rows.withColumns(
        {
            "kafka_timestamp": F.timestamp_micros(at),
            "pipeline_ts": F.col(at), "kafka_offset": F.col(tie).cast("bigint"), "cdc_op": F.lit("c"),
        }
    )


def plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone (UTC wall time), as the SQL side returns them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
