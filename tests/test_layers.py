"""Bronze to reports over the five seed patients."""

import datetime as dt

import pytest
from helpers import SEED, SEED_DAY, VITALS, rows_by, seed_records
from pyspark.sql import functions as F

from wardlake.plans import bronze, gold, questions, reports, retrieval, silver
from wardlake.schemas import CHANGE_RECORD, SOURCE_TABLES, union_schema
from wardlake.sources.changes import parse_table, parse_union, route


@pytest.fixture(scope="module")
def records(spark):
    rows = [{**r, "timestamp": dt.datetime(2024, 1, 1)} for r in seed_records()]
    return spark.createDataFrame(rows, CHANGE_RECORD)


@pytest.fixture(scope="module")
def bronze_tables(records):
    at = F.lit("2023-11-15 01:00:00").cast("timestamp")
    return {n: bronze.to_bronze(df, n, at) for n, df in route(records).items()}


@pytest.fixture(scope="module")
def silver_tables(bronze_tables):
    at = F.lit("2023-11-15 02:00:00").cast("timestamp")
    return {n: silver.build_silver(n, df, SEED_DAY, at) for n, df in bronze_tables.items()}


@pytest.fixture(scope="module")
def marts(silver_tables):
    return {n: gold.build_mart(n, silver_tables, SEED_DAY).cache() for n in gold.MARTS}


def test_union_schema_reads_shared_names_as_text():
    fields = {f.name: f.dataType.typeName() for f in union_schema().fields}
    assert fields["created_at"] == "string" and fields["heart_rate"] == "integer"
    assert len(fields) == len(set(fields))


def test_parse_union(records):
    parsed = parse_union(records)
    assert parsed.count() == 20 and {"topic", "kafka_ts"} <= set(parsed.columns)


def test_unreadable_values_and_tombstones_have_no_key(spark):
    lines = [("t", 0, i, None, None, v) for i, v in enumerate([None, "{", '{"vital_id": "x"}', '{"vital_id": 3}'])]
    parsed = parse_table(spark.createDataFrame(lines, CHANGE_RECORD), SOURCE_TABLES["vitals"])
    assert [r.kafka_offset for r in bronze.to_bronze(parsed, "vitals").collect()] == [3]


def test_json_is_parsed_once(records):
    plan = parse_table(records, SOURCE_TABLES["vitals"])._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_no_personal_data_in_bronze(bronze_tables):
    patients = bronze_tables["patients"]
    personal = {"ssn", "phone", "email", "address", "first_name", "last_name"}
    assert not personal & set(patients.columns)
    one = rows_by(patients, "patient_id")[1]
    assert one.ssn_masked == "01a54629efb95228" and one.source_table == "patients"
    assert rows_by(patients, "patient_id")[2].ssn_masked is None


def test_bronze_enrichment(bronze_tables):
    assert [r.is_icu for r in bronze_tables["adt_events"].orderBy("event_id").collect()] == [
        False, True, False, False, False]
    labs = rows_by(bronze_tables["lab_results"], "result_id")
    assert [labs[i].is_critical for i in range(1, 6)] == [True, True, False, False, False]
    assert labs[5].result_numeric is None and labs[1].result_numeric == 0.08


def test_silver_patients(silver_tables):
    people = rows_by(silver_tables["patients"], "patient_id")
    assert people[1].mrn_hash == "33e17aba51daa479" and "mrn" not in people[1]
    assert people[1].date_of_birth_dt == dt.date(1965, 3, 12)
    assert [people[i].age_years for i in range(1, 6)] == [58, 45, None, 8, None]
    assert [people[i].age_group for i in range(1, 6)] == [
        "ADULT", "ADULT", "SENIOR", "PEDIATRIC", "SENIOR"]
    assert [people[i].gender for i in range(1, 6)] == ["M", "F", "U", "F", "M"]
    assert [people[i].dq_complete for i in range(1, 6)] == [True, True, False, True, True]


def test_silver_scores(silver_tables):
    vitals = rows_by(silver_tables["vitals"], "vital_id")
    scores = {i: (r.news_hr_flag, r.news_spo2_flag, r.news2_score, r.news2_risk, r.alert_flags) for i, r in vitals.items()}
    assert scores == {
        1: (1, 0, 1, "LOW", "NORMAL"),
        2: (2, 3, 5, "HIGH", "CRITICAL_LOW_SPO2"),
        3: (0, 0, 0, "LOW", "NORMAL"),
        4: (0, 0, 0, "LOW", "NORMAL"),
        5: (1, 0, 1, "LOW", "NORMAL"),
    }


def test_bounds_do_not_change_scores(spark):
    row = {**VITALS[0], "heart_rate": 300, "spo2": 40}
    df = silver.bound_vitals(silver.score_vitals(spark.createDataFrame([row])))
    found = df.first()
    assert (found.heart_rate, found.spo2, found.news2_score, found.news2_risk) == (None, None, 6, "HIGH")


def test_silver_keeps_the_newest_version_and_its_operation(spark):
    rows = [(1, "A", "c", 1, 1), (1, "B", "u", 2, 2), (2, "C", "c", 1, 3), (2, None, "d", 1, 4), (None, "D", "c", 1, 5)]
    # The log was read again from its start: what arrives last is not what is newest.
    rows += [(1, "A", "c", 9, 1), (2, "C", "c", 9, 3)]
    df = spark.createDataFrame(rows, "patient_id BIGINT, mrn STRING, cdc_op STRING, pipeline_ts INT, kafka_offset INT")
    df = df.withColumns({"kafka_timestamp": F.lit("2024-01-01").cast("timestamp"), "date_of_birth": F.lit("2000-01-01"), "gender": F.lit("F")})
    found = rows_by(silver.silver_patients(df, "2020-01-01"), "patient_id")
    assert {k: r.cdc_op for k, r in found.items()} == {1: "u", 2: "d"}
    assert found[1].insurance_id is None


def test_patient_summary(marts):
    people = rows_by(marts["patient_summary"], "patient_id")
    assert [people[i].total_encounters for i in range(1, 6)] == [1] * 5
    assert [people[i].total_admits for i in range(1, 6)] == [1, 1, 0, 1, 1]
    assert [people[i].icu_admissions for i in range(1, 6)] == [0, 1, 0, 0, 0]
    assert [people[i].critical_labs_90d for i in range(1, 6)] == [1, 1, 0, 0, 0]
    assert people[2].latest_spo2 == 88.0 and people[2].latest_news2_risk == "HIGH"
    assert marts["patient_summary"].columns[-1] == "gold_computed_at"


def test_unmatched_counts_stay_null(silver_tables):
    none = {n: df.filter(F.lit(False)) for n, df in silver_tables.items()}
    none["patients"] = silver_tables["patients"]
    found = gold.build_mart("patient_summary", none, SEED_DAY).first()
    assert found.total_encounters is None and found.lab_count_90d is None


def test_lab_window_edges(silver_tables):
    labs = silver_tables["lab_results"]
    day = dt.date(2023, 11, 14)
    for days, expected in ((90, 5), (91, 0)):
        summed = gold.recent_lab_counts(labs, day + dt.timedelta(days=days))
        assert (summed.agg(F.sum("lab_count_90d")).first()[0] or 0) == expected
    assert gold.critical_alerts(labs, silver_tables["patients"], day + dt.timedelta(days=7)).count() == 2
    assert gold.critical_alerts(labs, silver_tables["patients"], day + dt.timedelta(days=8)).count() == 0


def test_latest_vitals_takes_the_higher_id_on_a_tie(silver_tables):
    vitals = silver_tables["vitals"].withColumn("patient_id", F.lit(1))
    assert gold.latest_vitals(vitals).first().latest_hr == 95.0


def test_other_marts(marts):
    assert marts["encounter_metrics"].count() == 5
    assert rows_by(marts["critical_alerts"], "result_id").keys() == {1, 2}
    board = marts["quality_dashboard"].collect()
    assert [(str(r.metric_date), r.patient_count, r.dq_completeness_pct, r.lab_count) for r in board if r.patient_count] == [
        (SEED_DAY, 5, 80.0, None)]
    assert [r.alert_count for r in board if r.vital_count] == [1]


def test_census(marts):
    census = {(r.ward, r.event_type): r.event_count for r in marts["daily_census"].collect()}
    assert census == {("Cardiology", "ADMIT"): 1, ("ICU", "ADMIT"): 2, ("Med-Surg", "TRANSFER"): 1, ("Maternity", "ADMIT"): 1}


def test_lab_turnaround(spark):
    rows = [("TROP", 0, 120_000_000), ("TROP", 0, 60_000_000), ("TROP", None, 1)]
    df = spark.createDataFrame(rows, "test_code STRING, collected_at BIGINT, resulted_at BIGINT")
    found = gold.lab_turnaround(df).first()
    assert (found.result_count, found.avg_minutes, found.max_minutes) == (2, 1.5, 2.0)


def test_turnaround_quantiles_from_merged_sketches(spark):
    day, n = 86_400_000_000, 30_000
    df = spark.range(n).selectExpr(
        "id AS result_id", "if(id % 3 = 0, 'K', 'NA') AS test_code", f"id % 40 * {day} AS resulted_at",
        f"id % 40 * {day} - (id * 7919 % {n}) * 60000000 AS collected_at",
    )
    sketches = gold.turnaround_sketches(df.unionByName(spark.createDataFrame([(-1, "NULLS", 0, None)], df.schema)))
    assert sketches.select("metric_date", "test_code").distinct().count() == sketches.count()
    shares = {"p1": 0.01, "p50": 0.5, "p95": 0.95}
    for r in gold.turnaround_quantiles(sketches, ["test_code"], shares).collect():
        times = sorted(i * 7919 % n for i in range(n) if (i % 3 == 0) == (r.test_code == "K"))
        assert r.result_count == len(times)
        for name, share in shares.items():
            assert r[name] in times and abs(times.index(r[name]) / len(times) - share) <= gold.RANK_ERROR
    whole = gold.turnaround_quantiles(sketches, []).collect()
    assert [r.result_count for r in whole] == [n] and abs(whole[0].p50_minutes - n / 2) <= gold.RANK_ERROR * n


def test_unknown_mart(silver_tables):
    with pytest.raises(KeyError, match="patient_360"):
        gold.build_mart("patient_360", silver_tables)


def test_time_filter_reaches_the_scan(spark, silver_tables, tmp_path):
    silver_tables["lab_results"].write.parquet(str(tmp_path / "labs"))
    labs = spark.read.parquet(str(tmp_path / "labs"))
    plan = gold.recent_lab_counts(labs, SEED_DAY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(result_time" in plan


def test_summary_shuffles_each_side_once(spark, silver_tables, tmp_path):
    """Four inputs joined on one key need four exchanges and no more."""
    tables = {}
    for name, df in silver_tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summary = gold.build_mart("patient_summary", tables, SEED_DAY)
        plan = summary._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(patient_id") == 4
    assert plan.count("Exchange ") == 4


# Reports and questions ---------------------------------------------------------------


def test_population_counts_are_null_when_nobody_matches(marts):
    men = marts["patient_summary"].filter("gender = 'M'")
    found = reports.population(men).first()
    assert (found.total_patients, found.female, found.male, found.avg_age) == (2, None, 2, 58.0)


def test_risk_order(marts):
    levels = [r.news2_risk for r in reports.risk_distribution(marts["encounter_metrics"]).collect()]
    assert levels == ["HIGH", "LOW"]


def test_top_patients(marts):
    assert [r.patient_id for r in reports.top_critical(marts["patient_summary"]).collect()][:2] == [1, 2]


def test_census_report_and_wards(marts):
    day = reports.census(marts["daily_census"]).first()
    assert (day.admissions, day.discharges, day.transfers, day.total_events) == (4, 0, 1, 5)
    assert reports.busiest_wards(marts["daily_census"]).first().ward == "ICU"
    assert reports.wards(marts["encounter_metrics"]).first().encounters == 2


def test_run_reports_records_problems_and_goes_on(marts):
    def read(name):
        if name == "daily_census":
            raise LookupError("not published")
        return marts[name]

    run = reports.run_reports(read, ["patient_summary", "nonsense", "daily_census", "critical_alerts"])
    assert set(run.problems) == {"nonsense", "daily_census"}
    assert {n[:3] for n in run.frames} == {"q1_", "q2_", "q3_", "q8_", "q9_"}
    assert set(reports.run_reports(marts.__getitem__).frames) == set(reports.REPORTS)


def test_questions(marts):
    summary = marts["patient_summary"]
    ids = lambda df: {r.patient_id for r in df.collect()}
    assert ids(questions.icu_patients(summary)) == {2}
    assert ids(questions.critical_patients(summary)) == {1, 2}
    assert ids(questions.high_risk_low_spo2(summary)) == {2}
    assert ids(questions.women_over_60(summary)) == set()
    week = {r.ward: r.admissions for r in questions.admissions_week(marts["daily_census"], SEED_DAY).collect()}
    assert week == {"Cardiology": 1, "ICU": 2, "Maternity": 1}
    assert {r[0]: r[1] for r in questions.risk_counts(summary).collect()} == {"HIGH": 1, "LOW": 4}


# Notes -------------------------------------------------------------------------------

NOTES = [
    (1, 2, "ADMISSION", "Dr. S", dt.datetime(2024, 1, 1, 9, 5), "Acute RESPIRATORY distress " + "x" * 300),
    (2, 2, "NURSING", "Nurse C", dt.datetime(2024, 1, 2, 9, 5), "wheezes, respiratory support"),
    (3, 1, "PROGRESS", "Dr. S", None, "stent placed"),
    (4, 99, "PROGRESS", "Dr. X", None, "respiratory, unknown patient"),
]


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(
        NOTES, "note_id INT, patient_id BIGINT, note_type STRING, authored_by STRING, authored_at TIMESTAMP, note_text STRING"
    )


def test_note_questions(notes, marts):
    found = questions.note_search(notes, marts["patient_summary"], "Respiratory")
    assert {r.note_id for r in found.collect()} == {1, 2}
    assert [tuple(r) for r in questions.notes_by_author(notes).collect()] == [("Dr. S", 2)]


def test_retrieval_end_to_end(notes, marts):
    texts = retrieval.note_text(notes)
    assert texts.filter("note_id = 3").first().embed_text == "Patient 1 | PROGRESS by Dr. S: stent placed"
    model = retrieval.fit_embedder(texts, dims=64)
    corpus = retrieval.embed(model, texts)
    asked = notes.sparkSession.createDataFrame([("a", "respiratory support wheezes,")], "query_id STRING, embed_text STRING")
    from wardlake.operators.vectors import cosine_topk

    hits = cosine_topk(corpus, retrieval.embed(model, asked, key="query_id"), k=2)
    found = retrieval.hit_notes(hits, corpus)
    used = retrieval.notes_used(found).orderBy("place").collect()
    assert used[0].patient_id == 2 and used[0].place == 1 and used[0].text.endswith("support...")
    context = retrieval.note_context(found).first().context
    assert context.startswith("[Patient 2 | NURSING by Nurse C | similarity=")
    assert "| 2024-01-02 09:05]\nwheezes, respiratory support" in context
    people = retrieval.hit_patients(found)
    lines = retrieval.structured_context(people, marts["patient_summary"], marts["critical_alerts"])
    found_lines = {(r.section, r.line) for r in lines.filter("patient_id = 2").collect()}
    assert found_lines == {
        ("STRUCTURED DATA", "  Patient 2: age=45 gender=F NEWS2=HIGH SpO2=88.0% HR=118.0bpm SBP=90.0mmHg ICU=1 critical_labs=1"),
        ("CRITICAL ALERTS", "  Patient 2: Blood Gas = 7.31 pH (LOW)"),
    }


def test_missing_values_are_spelled_out(notes):
    found = notes.filter("note_id = 3").selectExpr("*", "'q' AS query_id", "1 AS place", "0.5 AS score")
    assert "similarity=0.5 | None]" in retrieval.note_context(found).first().context


def test_preview_is_cut_but_the_note_is_not(notes):
    found = notes.filter("note_id = 1").selectExpr("*", "'q' AS query_id", "1 AS place", "0.5 AS score")
    assert len(retrieval.notes_used(found).first().text) == 203
    assert NOTES[0][5] in retrieval.note_context(found).first().context


def test_seed_has_every_table():
    assert set(SEED) == set(SOURCE_TABLES)


def test_a_section_without_lines_counts_zero(frame):
    lines = frame([(retrieval.STRUCTURED, 1), (retrieval.STRUCTURED, 1), (retrieval.STRUCTURED, 2)], "section string, patient_id int")
    counts = {tuple(r) for r in retrieval.section_counts(lines).collect()}
    assert counts == {(retrieval.STRUCTURED, 3, 2), (retrieval.ALERTS, 0, 0)}
    assert {tuple(r)[1:] for r in retrieval.section_counts(lines.limit(0)).collect()} == {(0, 0)}
