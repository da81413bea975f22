import pytest
from pyspark.sql import functions as F

from wardlake.plans import semantic


def test_domain_check(frame):
    summary = frame(
        [("M", "ADULT", "HIGH"), ("U", "SENIOR", None), (None, "SENIOR", "LOW")],
        "gender STRING, age_group STRING, latest_news2_risk STRING",
    )
    notes = frame([("NURSING",), ("OTHER",)], "note_type STRING")
    found = {
        (r.table_name, r.column_name): (r.row_count, r.null_count, r.violation_count)
        for r in semantic.domain_check({"patient_summary": summary, "clinical_notes": notes}).collect()
    }
    assert found == {
        ("patient_summary", "gender"): (3, 1, 1),
        ("patient_summary", "age_group"): (3, 0, 1),
        ("patient_summary", "latest_news2_risk"): (3, 1, 0),
        ("clinical_notes", "note_type"): (2, 0, 1),
    }
    with pytest.raises(ValueError):
        semantic.domain_check({})


def test_relationship_check(frame):
    summary = frame([(1,), (2,)], "patient_id INT")
    alerts = frame([(1,), (3,), (3,), (4,), (None,)], "patient_id INT")
    clean = frame([(2,)], "patient_id INT")
    found = semantic.relationship_check(
        {"patient_summary": summary, "critical_alerts": alerts, "clinical_notes": clean}
    )
    assert {r.child: (r.orphan_rows, r.orphan_keys) for r in found.collect()} == {
        "critical_alerts": (3, 2), "clinical_notes": (0, 0)}


RESPONSES = [
    ("SELECT 1 FROM patient_summary", "SELECT 1 FROM patient_summary"),
    ("```sql\nSELECT a\nFROM t\n```", "SELECT a\nFROM t"),
    ("Here is the query:\nSELECT a FROM t\nThis query reads t.", "SELECT a FROM t"),
    ("I'll do it\n\n  SELECT a FROM t  \n", "SELECT a FROM t"),
    ("The following:\n ```\nSELECT a FROM t\n ```\t\n", "SELECT a FROM t"),
    ("SELECT 1", None),
    ("", None),
    (None, None),
    ("note: nothing", None),
]


def test_clean_responses(frame):
    df = frame([(i, r) for i, (r, _) in enumerate(RESPONSES)], "i INT, response STRING")
    found = semantic.clean_responses(df).orderBy("i").collect()
    assert [r.sql_text for r in found] == [sql for _, sql in RESPONSES]
    assert [r.is_valid for r in found] == [sql is not None for _, sql in RESPONSES]


def test_strip_fences(frame):
    df = frame([("```sql\nSELECT 1\n```\n",)], "t STRING")
    assert df.select(semantic.strip_fences(F.col("t"))).first()[0] == "SELECT 1"


def test_run_sql(spark, frame):
    frame([(i, None if i % 2 else "x") for i in range(150)], "a INT, b STRING").createOrReplaceTempView("t")
    found = semantic.run_sql(spark, "```sql\nSELECT a, b, b FROM t ORDER BY a -- all\n```")
    assert found["success"] and found["columns"] == ["a", "b", "b"] and found["count"] == 100 and found["truncated"]
    assert semantic.run_sql(spark, "SELECT a FROM t", rows=150)["truncated"] is False
    assert found["rows"][:2] == [["0", "x", "x"], ["1", "—", "—"]]


def test_words_of_texts_and_columns_are_no_calls(spark, frame):
    frame([("they reflect (well)", 1)], "note STRING, reflect INT").createOrReplaceTempView("words")
    for sql in ("SELECT reflect FROM words WHERE note LIKE '%reflect (%'", 'SELECT note, "reflect(x)" FROM words -- reflect(y)'):
        assert semantic.run_sql(spark, sql)["count"] == 1


@pytest.mark.parametrize(
    "sql",
    [
        "DROP VIEW t",
        "CREATE TABLE z AS SELECT 1",
        "SELECT 1) AS a; DROP VIEW t; SELECT * FROM (SELECT 1",
        "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
        "SELECT nothing FROM t",
        "SELECT * FROM text.`/etc/hostname`",
        "SELECT * FROM parquet.`/tmp`",
        "SELECT java_method('java.lang.System', 'getenv', 'HOME') FROM t",
        "SELECT `reflect`('java.lang.System', 'getenv', 'HOME') FROM t",
        r"SELECT r'\', reflect('java.lang.System', 'getenv', 'HOME'), '' FROM t",
        "SELECT 'it''s', /* ' */ reflect('java.lang.System', 'getenv', 'HOME') FROM t -- '",
        "SELECT reflect/* call */('java.lang.System', 'getenv', 'HOME') FROM t",
        "SELECT TRY_REFLECT ('java.lang.System', 'getenv', 'HOME') FROM t",
        "",
    ],
)
def test_only_queries_run(spark, frame, sql):
    frame([(1, "x")], "a INT, b STRING").createOrReplaceTempView("t")
    found = semantic.run_sql(spark, sql)
    assert found["success"] is False and found["error"]
    assert spark.catalog.tableExists("t") and not spark.catalog.tableExists("z")


def test_descriptions_are_column_comments(spark, frame):
    df = semantic.describe(frame([(1, 2)], "patient_id INT, icu_admissions INT"), "patient_summary")
    df.createOrReplaceTempView("described")
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE described").collect()}
    assert comments["icu_admissions"].startswith("ICU stays")
