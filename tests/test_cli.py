import json

from helpers import SEED_DAY, land, seed_records

from pyspark.sql import functions as F

from wardlake.__main__ import main, stored_cells
from wardlake.schemas import SOURCE_TABLES


def test_the_jobs_in_order(spark, tmp_path, capsys):
    for name, table in SOURCE_TABLES.items():
        land(tmp_path / "in" / name, "1", [r for r in seed_records() if r["topic"] == table.topic])
    base = ["--base", str(tmp_path / "lake")]
    assert main([*base, "bronze", "--landing", str(tmp_path / "in")]) == 0
    assert main([*base, "run", "--as-of", SEED_DAY]) == 0
    assert main([*base, "report"]) == 0
    shown = capsys.readouterr().out
    assert "q1_population" in shown and "q10_dq_kpis" in shown
    assert main([*base, "report", "--table", "nonsense"]) == 1
    assert "unknown mart" in capsys.readouterr().out
    assert main([*base, "health"]) == 0
    assert "patient_summary" in capsys.readouterr().out
    assert main([*base, "sql", "SELECT count(*) AS n FROM patient_summary"]) == 0
    assert json.loads(capsys.readouterr().out)["rows"] == [["5"]]
    notes = [(1, 1, "PROGRESS", "Dr. S", "chest pain settled"), (2, 2, "NURSING", "Nurse C", "wheezes, oxygen support")]
    spark.createDataFrame(notes, "note_id INT, patient_id BIGINT, note_type STRING, authored_by STRING, note_text STRING").withColumn(
        "authored_at", F.lit("2024-01-02 09:05:00").cast("timestamp")
    ).write.parquet(str(tmp_path / "lake" / "clinical_notes"))
    asked = "SELECT n.note_id, s.gender FROM clinical_notes n JOIN patient_summary s USING (patient_id) ORDER BY note_id"
    assert main([*base, "sql", asked, "--rows", "1"]) == 0
    answer = json.loads(capsys.readouterr().out)
    assert answer["rows"] == [["1", "M"]] and answer["truncated"] is True
    assert main([*base, "embed"]) == 0
    assert main([*base, "retrieve", "oxygen support", "--hits", "1"]) == 0
    assert stored_cells(spark, str(tmp_path / "lake")).members().count() == 2
    parts = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert [(p["query_id"], p["note_id"]) for p in parts if p["part"] == "hits"] == [(0, 2)]
    assert {p["part"] for p in parts} == {"hits", "patients", "notes", "note_context", "structured_context"}
    assert spark.read.parquet(str(tmp_path / "lake" / "metrics" / "streaming")).count() > 0
    assert spark.read.parquet(str(tmp_path / "lake" / "metrics" / "health")).count() == 20
