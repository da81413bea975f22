"""The described layer: what each column may hold, how tables relate, and ad-hoc SQL."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values ------------------------------------------------------------------
# Declared values of coded columns.
DOMAINS = {
    "patient_summary": {
        "gender": ("M", "F"),
        "age_group": ("SENIOR", "PEDIATRIC"),
        "latest_news2_risk": ("HIGH", "MEDIUM", "LOW"),
    },
    "critical_alerts": {
        "gender": ("M", "F"),
        "abnormal_direction": ("HIGH", "LOW"),
    },
    "encounter_metrics": {
        "event_type": ("ADMIT", "DISCHARGE", "TRANSFER"),
        "news2_risk": ("HIGH", "MEDIUM", "LOW"),
    },
    "daily_census": {
        "event_type": ("ADMIT", "DISCHARGE", "TRANSFER"),
    },
    "clinical_notes": {
        "note_type": ("ADMISSION", "PROGRESS", "NURSING", "DISCHARGE"),
    },
}
# Child table -> (foreign key, parent table).
RELATIONSHIPS = {
    "critical_alerts": ("patient_id", "patient_summary"),
    "encounter_metrics": ("patient_id", "patient_summary"),
    "clinical_notes": ("patient_id", "patient_summary"),
}
# Line starts that mark prose in a generated answer.
PROSE_STARTS = (
    "here",
    "this query",
    "the query",
    "note:",
    "explanation",
    "this sql",
    "i'll",
    "this will",
    "the following",
)
SHORTEST_SQL = 10
ANSWER_ROWS = 100
MISSING = "—"
# ----------------------------------------------------------------------------------

DESCRIPTIONS = {
    "patient_summary": {
        "patient_id": "Patient key",
        "icu_admissions": "ICU stays; above 0 marks an ICU patient",
        "latest_spo2": "Last oxygen saturation in percent",
        "latest_news2_risk": "Last early-warning level",
        "critical_labs_90d": "Critical results of the last 90 days",
        "total_encounters": "Events of any type",
    },
    "critical_alerts": {
        "result_id": "Result key",
        "patient_id": "Patient key, see patient_summary",
        "abnormal_direction": "Side of the normal range",
    },
    "encounter_metrics": {
        "event_id": "Event key",
        "patient_id": "Patient key, see patient_summary",
        "vital_count": "Readings of the event's patient",
        "news2_risk": "Level of the patient's highest score",
    },
    "daily_census": {
        "event_date": "Day",
        "event_count": "Events of that day, ward and type",
    },
    "clinical_notes": {
        "note_id": "Note key",
        "patient_id": "Patient key, see patient_summary",
        "note_text": "Full text; search in lower case",
    },
}

_BLANKS = " \t\n\r\f\x0b"


def describe(df: DataFrame, table: str) -> DataFrame:
    """The table with its column comments, which ``DESCRIBE`` of a view shows."""
    for name, comment in DESCRIPTIONS.get(table, {}).items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": comment})
    return df


def domain_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, NULLs and undeclared values of every coded column. One aggregate per table."""
    checks = None
    for table, columns in DOMAINS.items():
        if table not in tables:
            continue
        figures = []
        for name, allowed in columns.items():
            figures += [
                F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"),
                F.count_if(~F.col(name).isin(*allowed)).alias(f"{name}_violations"),
            ]
        totals = tables[table].agg(F.count(F.lit(1)).alias("_rows"), *figures)
        lines = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.col("_rows").alias("row_count"),
                F.col(f"{name}_nulls").alias("null_count"),
                F.col(f"{name}_violations").alias("violation_count"),
            )
            for name in columns
        ]
        check = totals.select(F.inline(F.array(*lines)))
        checks = check if checks is None else checks.unionByName(check)
    if checks is None:
        raise ValueError("no described table given")
    return checks


def relationship_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose foreign key has no parent. Rows are counted per key before the join,
    so a frequent key is one row in it."""
    checks = None
    for child, (key, parent) in RELATIONSHIPS.items():
        if child not in tables or parent not in tables:
            continue
        counted = (
            tables[child]
            .filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        orphans = counted.join(tables[parent].select(key), key, "left_anti")
        check = orphans.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
            F.count(F.lit(1)).alias("orphan_keys"),
        ).select(F.lit(child).alias("child"), F.lit(parent).alias("parent"), "orphan_rows", "orphan_keys")
        checks = check if checks is None else checks.unionByName(check)
    if checks is None:
        raise ValueError("no related tables given")
    return checks


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def strip_fences(text: Column) -> Column:
    """The answer without code-fence marks."""
    bare = F.replace(F.replace(text, F.lit("```sql"), F.lit("")), F.lit("```"), F.lit(""))
    return strip_blanks(bare)


SQL_ON_FILES = "spark.sql.runSQLOnFiles"
JVM_CALLS = re.compile(r"(?i)\b(java_method|reflect|try_reflect)`?\s*\(")
# What the grammar takes as text: raw strings, in which a backslash is itself, other strings, and comments.
LITERALS = re.compile(
    r"""\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|--[^\n]*|/\*(?!\+).*?\*/""", re.DOTALL
)


def clean_sql(text: Column) -> Column:
    """The answer without fence lines and prose lines; the fenced content stays."""

    def is_code(line: Column) -> Column:
        prose = F.lit(False)
        for start in PROSE_STARTS:
            prose = prose | F.startswith(F.lower(line), F.lit(start))
        return ~(prose | F.startswith(strip_blanks(line), F.lit("```")))

    lines = F.split(strip_blanks(text), "\n")
    return strip_blanks(F.array_join(F.filter(lines, is_code), "\n"))


def clean_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """Cleaned SQL per response and whether it can be run; a failed one stays as a row."""
    cleaned = responses.withColumn("sql_text", clean_sql(F.col(text)))
    valid = F.coalesce(F.length("sql_text") >= SHORTEST_SQL, F.lit(False))
    return cleaned.withColumn("is_valid", valid).withColumn(
        "sql_text", F.when(F.col("is_valid"), F.col("sql_text"))
    )


def select_only(spark: SparkSession, sql: str) -> DataFrame:
    """A query over registered views. The text is placed in a subquery, where Spark's own
    grammar admits nothing but a query: no DDL, no insert, no second statement. Functions that
    call into the JVM are refused, and paths are not read as tables."""
    query = sql.strip().rstrip(";")
    if called := JVM_CALLS.search(LITERALS.sub(" ", query)):
        raise ValueError(f"{called[1]} is not allowed")
    before = spark.conf.get(SQL_ON_FILES)
    spark.conf.set(SQL_ON_FILES, "false")
    try:
        return spark.sql(f"SELECT * FROM (\n{query}\n) AS answer")
    finally:
        spark.conf.set(SQL_ON_FILES, before)


def answer_rows(spark: SparkSession, sql: str, rows: int = ANSWER_ROWS) -> DataFrame:
    """The first rows of the answer as text columns, with a dash for NULL."""
    found = select_only(spark, sql).limit(rows)
    places = [f"_c{i}" for i in range(len(found.columns))]  # two columns may share a name
    texts = [
        F.coalesce(F.col(place).cast("string"), F.lit(MISSING)).alias(name)
        for place, name in zip(places, found.columns)
    ]
    return found.toDF(*places).select(*texts)


def run_sql(spark: SparkSession, sql: str, rows: int = ANSWER_ROWS) -> dict:
    """One SQL text run on the registered views: the first ``rows`` rows, and whether the answer
    was ``truncated`` there. An error is returned, not raised."""
    text = sql.replace("```sql", "").replace("```", "").strip()
    try:
        found = answer_rows(spark, text, rows + 1)
        lines = [list(row) for row in found.collect()]  # at most one more than ``rows``
    except (PySparkException, ValueError) as error:
        return {"success": False, "error": str(error), "sql": ""}
    return {
        "success": True,
        "sql": text,
        "columns": found.columns,
        "rows": lines[:rows],
        "count": min(len(lines), rows),
        "truncated": len(lines) > rows,
    }
