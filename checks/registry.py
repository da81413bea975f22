"""One query per operator, over the whole of the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import AS_OF, CENSUS_AS_OF, Tables, plain_times
from wardlake.functions import clinical, mask_pii, mrn_digest, temporal
from wardlake.operators.balls import BallIndex
from wardlake.operators.dedupe import latest_per_key
from wardlake.operators.joins import join_unique
from wardlake.operators.merge import OP, change_op, merge_changes
from wardlake.operators.postings import TextIndex
from wardlake.operators.vectors import cosine_topk
from wardlake.plans import bronze, gold, metrics, questions, reports, retrieval, semantic, silver
from wardlake.schemas import PATIENTS, SOURCE_TABLES, VITALS
from wardlake.session import run_folder
from wardlake.sources.changes import parse_table, parse_union, read_landing, route, to_records
from wardlake.sources.tables import read_table, register_views
from wardlake.sources.splits import SplitTable
from wardlake.sources.versioned import CommittedTable
from wardlake.streaming.bronze import (
    append_bronze,
    await_all,
    read_bronze,
    read_dead_letters,
    start_bronze,
    write_bronze_batches,
    write_limited_batches,
)
from wardlake.streaming.listener import MetricsListener
from wardlake.streaming.pipeline import run_pipeline
from wardlake.streaming.silver import merge_bronze, read_silver

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}

NOTE_KEYWORD = "license"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Sources ---------------------------------------------------------------------------


def change_records(t: Tables, writers: int | None = None) -> dict[str, DataFrame]:
    """The source rows as change records, one topic per table."""
    sent = F.lit(AS_OF).cast("timestamp")
    # Later versions come later in the log.
    vitals_offset = F.expr("(created_at div 86400000000) * 10000000000 + tie")
    rows = {
        "patients": t.patients_cdc.withColumns(
            {
                "__op": F.col("op"),
                "__deleted": F.when(F.col("op") == "d", "true").otherwise("false"),
                "log_offset": F.col("patient_id") * 3 + F.col("ver"),
            }
        ),
        "adt_events": t.adt_raw.withColumn("log_offset", F.col("event_id")),
        "lab_results": t.labs_raw.withColumn("log_offset", F.col("result_id")),
        "vitals": t.vitals_raw.withColumn("log_offset", vitals_offset),
    }
    if writers:
        # What lies in that many parts is not dealt out again.
        rows = {name: frame if frame.rdd.getNumPartitions() >= writers else frame.repartition(writers) for name, frame in rows.items()}
    return {
        name: to_records(frame, SOURCE_TABLES[name], "log_offset", sent)
        for name, frame in rows.items()
    }


@query
def src_parquet(t: Tables) -> DataFrame:
    return read_table(t.spark, "orders.parquet", [f"{t.folder}/nowhere", t.folder]).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query
def src_json_parse_union(t: Tables) -> DataFrame:
    parsed = parse_union(union(list(change_records(t).values())))
    return parsed.select(
        "topic", "patient_id", "event_id", "result_id", "vital_id", "event_type", "test_code",
        "gender", "heart_rate", "temperature", "created_at",
    )


@query
def src_json_parse_topic(t: Tables) -> DataFrame:
    parsed = parse_table(change_records(t)["vitals"], VITALS)
    return parsed.select(
        "vital_id", "patient_id", "heart_rate", "systolic_bp", "diastolic_bp", "spo2",
        "temperature", "created_at", "kafka_offset", OP,
    )


@query
def src_topic_route(t: Tables) -> DataFrame:
    routed = route(union(list(change_records(t).values())))
    return union(
        [
            frame.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.sum(SOURCE_TABLES[name].key).alias("key_sum"),
            ).withColumn("table_name", F.lit(name))
            for name, frame in routed.items()
        ]
    )


@query
def src_delta_fallback(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    CommittedTable(t.spark, f"{folder}/second/daily_census").publish(t.mart("daily_census"))
    return read_table(t.spark, "daily_census", [f"{folder}/first", f"{folder}/second"])


@query
def src_view_register(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    for name in ("orders", "customer"):
        CommittedTable(t.spark, f"{folder}/{name}").publish(t.raw(name))
    registered = register_views(t.spark, ["orders", "absent", "customer"], [folder])
    return t.spark.sql(
        f"""SELECT c_mktsegment, count(*) AS order_count
           FROM {registered[0]} JOIN {registered[1]} ON o_custkey = c_custkey GROUP BY c_mktsegment"""
    )


# Sinks -----------------------------------------------------------------------------


@query
def snk_merge_cdc(t: Tables) -> DataFrame:
    rows = t.patients_cdc.select("patient_id", "mrn", "insurance_id", "op", "ver")
    target = rows.filter("ver = 1")
    source = latest_per_key(rows.filter("ver > 1"), "patient_id", ["ver"])
    return merge_changes(target, source, "patient_id", op="op")


@query
def snk_merge_on_read(t: Tables) -> DataFrame:
    """The clauses of snk_merge_cdc on a stored table, of which a merge writes the changes alone."""
    rows = t.patients_cdc.select(F.col("patient_id").cast("bigint").alias("patient_id"), "mrn", "insurance_id", "op", "ver")
    table = SplitTable(t.spark, f"{run_folder(t.spark)}/patients", "patient_id")
    table.merge(rows.filter("ver = 1"))
    table.merge(latest_per_key(rows.filter("ver > 1"), "patient_id", ["ver"]), op="op")
    return table.read()


@query
def chk_bronze_peek(t: Tables) -> DataFrame:
    return bronze.peek_patients(t.bronze["patients"])


@query
def chk_bronze_count(t: Tables) -> DataFrame:
    return bronze.count_rows(t.bronze["patients"])


#: Compressed landing files are read whole, by one task each: none has more records.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 500_000}


def landing(t: Tables, folder: str, names: list[str], **options) -> Callable:
    """Write change records as landing files; returns the stream source reading them.

    A topic has several partitions, so the records are spread over several writers.
    """
    records = change_records(t, writers=t.spark.sparkContext.defaultParallelism)
    for name in names:
        records[name].write.options(**LANDED | options).json(f"{folder}/landing/{name}")
    return lambda table: read_landing(t.spark, f"{folder}/landing/{table.name}", [table.topic])


@query
def snk_stream_append(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    source = landing(t, folder, ["adt_events"])
    await_all([append_bronze(source, SOURCE_TABLES["adt_events"], folder, every=None)])
    rows = read_bronze(t.spark, folder, "adt_events")
    return rows.select("event_id", "patient_id", "event_type", "ward", "is_icu", OP)


@query
def snk_foreach_batch(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    source = landing(t, folder, ["lab_results"])
    await_all([write_bronze_batches(source, SOURCE_TABLES["lab_results"], folder, every=None)])
    rows = read_bronze(t.spark, folder, "lab_results")
    return rows.select("result_id", "test_code", "result_numeric", "is_critical", OP)


@query
def snk_schema_merge(t: Tables) -> DataFrame:
    """A field that the source adds while the stream runs: later files have it, and Silver's run makes it a column."""
    folder, table = run_folder(t.spark), SOURCE_TABLES["adt_events"]
    records = change_records(t, writers=t.spark.sparkContext.defaultParallelism)["adt_events"]
    later = F.regexp_replace("value", r"\}$", F.concat(F.lit(', "triage": '), F.col("offset") % 5, F.lit(', "Unit-no": "x"}')))
    source = lambda table: read_landing(t.spark, f"{folder}/landing/{table.name}", [table.topic])
    for batch, value in enumerate(("value", later)):
        part = records.where(F.pmod("offset", F.lit(2)) == batch).withColumn("value", F.col("value") if batch == 0 else value)
        part.write.mode("append").options(**LANDED).json(f"{folder}/landing/adt_events")
        # What has landed is a batch, however many files it takes.
        await_all([append_bronze(source, table, folder, every=None)])
    await_all([merge_bronze(t.spark, folder, table, AS_OF)])
    rows = read_bronze(t.spark, folder, "adt_events")
    return rows.select("event_id", "ward", "triage", F.try_element_at("rescued", F.lit("Unit-no")).alias("unit"))


@query
def src_dead_letters(t: Tables) -> DataFrame:
    """Whole records, deletes with their tombstones, cut-off records and records without a key, and where each went."""
    folder, table = run_folder(t.spark), PATIENTS
    records = change_records(t)["patients"]
    deletes = records.filter(F.get_json_object("value", "$.__deleted") == "true")
    tombstones = deletes.withColumn("value", F.lit(None).cast("string"))
    broken = records.where("offset % 5 = 0").withColumn("value", F.expr("left(value, length(value) - 3)"))
    keyless = records.where("offset % 7 = 0").withColumn("value", F.regexp_replace("value", '"patient_id":', '"patient":'))
    union([records, tombstones, broken, keyless]).repartition(4).write.json(f"{folder}/landing/patients")
    source = lambda table: read_landing(t.spark, f"{folder}/landing/{table.name}", [table.topic])
    await_all([write_bronze_batches(source, table, folder, every=None)])
    rows = read_bronze(t.spark, folder, "patients").select(F.col("kafka_offset").alias("offset"), F.lit("row").alias("went"))
    letters = read_dead_letters(t.spark, folder, "patients").select("offset", F.col("cause").alias("went"))
    return union([rows, letters]).groupBy("offset", "went").agg(F.count(F.lit(1)).alias("n"))


@query
def snk_gold_overwrite(t: Tables) -> DataFrame:
    table = CommittedTable(t.spark, f"{run_folder(t.spark)}/gold/daily_census")
    census = t.mart("daily_census")
    table.publish(census.withColumn("event_count", F.lit(0)))
    table.publish(census)
    return table.read()


# Bronze ----------------------------------------------------------------------------


@query
def brz_mask_pii(t: Tables) -> DataFrame:
    masked = {c: mask_pii(c) for c in ("ssn", "phone", "email")}
    return t.patients_cdc.select(
        "patient_id", "ver", *[m.alias(f"{c}_masked") for c, m in masked.items()]
    )


@query
def brz_patients(t: Tables) -> DataFrame:
    return t.bronze["patients"].drop("kafka_timestamp", "pipeline_ts", "kafka_offset", OP)


@query
def brz_adt(t: Tables) -> DataFrame:
    return t.bronze["adt_events"].select(
        "event_id", "patient_id", "event_type", "ward", "is_icu", "source_table"
    )


@query
def brz_labs(t: Tables) -> DataFrame:
    return t.bronze["lab_results"].select(
        "result_id", "test_code", "abnormal_flag", "result_value", "result_numeric",
        "is_critical", "source_table",
    )


@query
def brz_vitals(t: Tables) -> DataFrame:
    return t.bronze["vitals"].select(
        "vital_id", "tie", "heart_rate", "spo2", "systolic_bp", "alert_flags", "has_alerts",
        "source_table",
    )


@query
def brz_live_filter(t: Tables) -> DataFrame:
    return bronze.live_changes(t.bronze["patients"]).select("patient_id", "mrn_hash", "ver")


@query
def brz_tombstone(t: Tables) -> DataFrame:
    records = change_records(t)["patients"]
    # A delete is followed by a record without a value. Unreadable copies come in between.
    deletes = records.filter(F.get_json_object("value", "$.__deleted") == "true")
    tombstones = deletes.withColumn("value", F.lit(None).cast("string"))
    broken = records.withColumn("value", F.concat(F.lit("<"), "value"))
    parsed = parse_table(union([records, tombstones, broken]), PATIENTS)
    kept = bronze.keyed_changes(parsed, "patient_id")
    return kept.select("patient_id", "mrn", OP, "kafka_offset")


# Silver ----------------------------------------------------------------------------


@query
def slv_key_filter(t: Tables) -> DataFrame:
    key = F.when(F.col("tie") % 5 != 0, F.col("vital_id"))
    rows = t.vitals_raw.withColumn("vital_id", key)
    return bronze.keyed_changes(rows, "vital_id").select("vital_id", "patient_id", "tie")


@query
def slv_cdc_op(t: Tables) -> DataFrame:
    rows = t.patients_cdc.withColumns(
        {
            "__op": F.when(F.col("ver") == 2, F.col("op")),
            "__deleted": F.when(F.col("ver") == 3, "true").when(F.col("ver") == 2, "false"),
        }
    )
    return rows.select("patient_id", "ver", change_op(rows.columns).alias("cdc_op"))


@query
def slv_mrn_hash(t: Tables) -> DataFrame:
    return t.patients_cdc.select("patient_id", "ver", mrn_digest("mrn").alias("mrn_hash"))


def born(t: Tables) -> DataFrame:
    dob = temporal.birth_date("date_of_birth")
    return t.patients_cdc.select(
        "patient_id", "ver", "date_of_birth", "gender", dob.alias("date_of_birth_dt")
    )


@query
def slv_dob(t: Tables) -> DataFrame:
    return born(t).drop("gender")


@query
def slv_age(t: Tables) -> DataFrame:
    age = temporal.age_in_years("date_of_birth_dt", AS_OF)
    return born(t).select("patient_id", "ver", age.alias("age_years"))


@query
def slv_age_group(t: Tables) -> DataFrame:
    aged = silver.with_age(born(t), AS_OF)
    return aged.select("patient_id", "ver", "age_years", "age_group")


@query
def slv_gender(t: Tables) -> DataFrame:
    return t.patients_cdc.select("patient_id", "ver", clinical.normal_gender().alias("gender"))


@query
def slv_dq_complete(t: Tables) -> DataFrame:
    return t.silver_versions["patients"].select("patient_id", "dq_complete")


@query
def slv_event_time(t: Tables) -> DataFrame:
    return t.silver_versions["adt_events"].select("event_id", "event_time", "created_at_ts")


@query
def slv_event_type(t: Tables) -> DataFrame:
    return t.silver_versions["adt_events"].select("event_id", "event_type", "is_icu")


@query
def slv_lab_direction(t: Tables) -> DataFrame:
    return t.labs_raw.select("result_id", clinical.lab_direction().alias("abnormal_direction"))


@query
def slv_is_abnormal(t: Tables) -> DataFrame:
    return t.labs_raw.select("result_id", clinical.is_abnormal().alias("is_abnormal"))


@query
def slv_news_spo2(t: Tables) -> DataFrame:
    points = clinical.spo2_points().alias("news_spo2_flag")
    return t.vitals_raw.select("vital_id", "tie", "spo2", points)


@query
def slv_news_hr(t: Tables) -> DataFrame:
    points = clinical.heart_rate_points().alias("news_hr_flag")
    return t.vitals_raw.select("vital_id", "tie", "heart_rate", points)


@query
def slv_news2(t: Tables) -> DataFrame:
    scored = silver.score_vitals(t.vitals_raw)
    return scored.select("vital_id", "tie", "news2_score", "news2_risk")


@query
def slv_vital_bounds(t: Tables) -> DataFrame:
    bounded = silver.bound_vitals(t.vitals_raw)
    return bounded.select("vital_id", "tie", *clinical.VITAL_BOUNDS)


@query
def slv_cast_vitals(t: Tables) -> DataFrame:
    return silver.cast_vitals(t.vitals_raw).select("vital_id", "tie", *clinical.VITAL_BOUNDS)


@query
def slv_dedupe_latest(t: Tables) -> DataFrame:
    newest = latest_per_key(t.vitals_raw, "vital_id", silver.NEWEST_BY)
    return newest.select("vital_id", "patient_id", "created_at", "tie")


def silver_rows(t: Tables, name: str) -> DataFrame:
    return t.silver_versions[name].drop(*silver.NEWEST_BY)


@query
def slv_patients(t: Tables) -> DataFrame:
    return silver_rows(t, "patients")


@query
def slv_adt(t: Tables) -> DataFrame:
    return silver_rows(t, "adt_events")


@query
def slv_labs(t: Tables) -> DataFrame:
    return silver_rows(t, "lab_results")


@query
def slv_vitals(t: Tables) -> DataFrame:
    return silver_rows(t, "vitals")


# Joins -----------------------------------------------------------------------------


@query
def join_left_chain(t: Tables) -> DataFrame:
    chain = gold.with_patient_figures(
        t.silver["patients"],
        gold.latest_vitals(t.silver["vitals"]),
        gold.encounter_counts(t.silver["adt_events"]),
        gold.recent_lab_counts(t.silver["lab_results"], AS_OF),
    )
    return chain.select("patient_id", "latest_hr", "total_encounters", "lab_count_90d")


@query
def join_left_agg(t: Tables) -> DataFrame:
    ranges = gold.vital_ranges(t.silver["vitals"])
    events = t.silver["adt_events"].select("event_id", "patient_id")
    joined = join_unique(events, ranges, "patient_id")
    return joined.select("event_id", "patient_id", "vital_count", "max_news2_score")


@query
def join_left_dim(t: Tables) -> DataFrame:
    labs = t.silver["lab_results"].filter("is_critical").select("result_id", "patient_id")
    people = t.silver["patients"].select("patient_id", "gender", "age_years")
    return join_unique(labs, people, "patient_id")


@query
def join_full_outer_using(t: Tables) -> DataFrame:
    tables = t.silver["patients"], t.silver["lab_results"], t.silver["vitals"]
    joined = gold.quality_dashboard(*tables, t.at)
    return joined.select("metric_date", "patient_count", "lab_count", "vital_count")


@query
def join_merge_key(t: Tables) -> DataFrame:
    # Where every change is a deletion, what is left are the rows whose key matched none.
    rows = t.patients_cdc.select("patient_id", "mrn", "ver", F.lit("c").alias("op"))
    changed = rows.filter("ver > 1").withColumn("op", F.lit("d"))
    source = latest_per_key(changed, "patient_id", ["ver"])
    return merge_changes(rows.filter("ver = 1"), source, "patient_id", op="op").drop("op")


@query
def join_notes(t: Tables) -> DataFrame:
    joined = questions.notes_with_patients(t.notes, t.mart("patient_summary"))
    return joined.select("note_id", "patient_id", "note_type", "gender", "latest_news2_risk")


@query
def join_id_filter(t: Tables) -> DataFrame:
    return retrieval.section_counts(retrieval.structured_context(t.notes, t.mart("patient_summary"), t.mart("critical_alerts")))


# Aggregations and marts ------------------------------------------------------------


@query
def agg_encounters(t: Tables) -> DataFrame:
    return gold.encounter_counts(t.silver["adt_events"])


@query
def agg_labs_90d(t: Tables) -> DataFrame:
    return gold.recent_lab_counts(t.silver["lab_results"], AS_OF)


@query
def agg_vitals(t: Tables) -> DataFrame:
    return gold.vital_ranges(t.silver["vitals"])


@query
def agg_dq_patients(t: Tables) -> DataFrame:
    return gold.table_quality("patients", t.silver["patients"])


@query
def agg_dq_labs(t: Tables) -> DataFrame:
    return gold.table_quality("lab_results", t.silver["lab_results"])


@query
def agg_dq_vitals(t: Tables) -> DataFrame:
    return gold.table_quality("vitals", t.silver["vitals"])


def mart_query(key: str, mart: str) -> None:
    QUERIES[key] = lambda t: t.mart(mart)


for mart_name in gold.MARTS:
    mart_query(f"gold_{mart_name}", mart_name)


@query
def gold_turnaround_quantiles(t: Tables) -> DataFrame:
    """Quantiles per test and month from stored daily sketches, and whether their exact ranks are within the stated error."""
    store = CommittedTable(t.spark, f"{run_folder(t.spark)}/sketches")
    store.publish(gold.turnaround_sketches(t.silver["lab_results"]))
    month = F.trunc("metric_date", "month").alias("month")
    found = gold.turnaround_quantiles(store.read(), ["test_code", month])
    exact = gold.lab_minutes(t.silver["lab_results"]).select("test_code", month, "minutes")
    ranks = []
    for name, share in (("p50", 0.5), ("p95", 0.95)):
        below = F.avg(F.when(F.col("minutes") < F.col(f"{name}_minutes"), 1.0).otherwise(0.0))
        upto = F.avg(F.when(F.col("minutes") <= F.col(f"{name}_minutes"), 1.0).otherwise(0.0))
        within = (below <= share + gold.RANK_ERROR) & (upto >= share - gold.RANK_ERROR)
        ranks.append(within.alias(f"{name}_within"))
    joined = exact.join(found, ["test_code", "month"])
    return joined.groupBy("test_code", "month").agg(F.max("result_count").alias("result_count"), *ranks)


# Windows ---------------------------------------------------------------------------


@query
def win_latest_per_key(t: Tables) -> DataFrame:
    newest = latest_per_key(t.patients_cdc, "patient_id", ["ver"])
    return newest.select("patient_id", "op", "ver", "insurance_id")


@query
def win_latest_vitals(t: Tables) -> DataFrame:
    return gold.latest_vitals(t.silver["vitals"])


# Reports ---------------------------------------------------------------------------


def report_query(key: str) -> None:
    mart, report = reports.REPORTS[key]
    QUERIES[key] = lambda t: report(t.mart(mart))


for report_name in reports.REPORTS:
    report_query(report_name)


@query
def report_runner(t: Tables) -> DataFrame:
    """How many rows the reports of all marts have, and an unknown mart as a problem."""
    run = reports.run_reports(lambda name: t.marts[name], [*sorted({mart for mart, _ in reports.REPORTS.values()}), "nonsense"])
    counts = [frame.agg(F.count(F.lit(1)).alias("row_count")).withColumn("name", F.lit(n)) for n, frame in run.frames.items()]
    problem = t.spark.createDataFrame([(-1, name) for name in run.problems], "row_count BIGINT, name STRING")
    return union([*counts, problem]).select("name", "row_count")


# Described layer and questions -----------------------------------------------------


def described(t: Tables) -> dict[str, DataFrame]:
    return {**t.marts, "clinical_notes": t.notes}


@query
def sem_domain_check(t: Tables) -> DataFrame:
    return semantic.domain_check(described(t))


@query
def sem_relationship_check(t: Tables) -> DataFrame:
    return semantic.relationship_check(described(t))


@query
def sem_sql_clean(t: Tables) -> DataFrame:
    # Answers in the forms a model gives, around the text of every document.
    response = F.expr(
        """CASE doc_id % 6
           WHEN 0 THEN text
           WHEN 1 THEN '```sql\n' || text || '\n```'
           WHEN 2 THEN 'Here is the query:\n  ' || text || '\n\nThis query reads one table.'
           WHEN 3 THEN 'NOTE: none\n' || text
           WHEN 4 THEN ' \n\t```\nSELECT ' || cast(doc_id as string) || '\n ```  \nExplanation: ' || text
           ELSE 'note: ' || text || '\n\t' || text END"""
    )
    # Beside every document, an answer that is too short and an empty one.
    responses = t.raw("documents").select(
        "doc_id", F.explode(F.array(response, F.expr("'NOTE: none\n' || left(text, 4)"), F.lit(""))).alias("response")
    )
    return semantic.clean_responses(responses).select("doc_id", "sql_text", "is_valid")


@query
def sem_fence_strip(t: Tables) -> DataFrame:
    response = F.expr("'```sql\n' || text || '\n```\n'")
    rows = t.raw("documents").select("doc_id", response.alias("response"))
    return rows.select("doc_id", semantic.strip_fences(F.col("response")).alias("sql_text"))


@query
def sem_run_sql(t: Tables) -> DataFrame:
    t.mart("patient_summary").createOrReplaceTempView("patient_summary")
    return semantic.answer_rows(
        t.spark,
        """SELECT patient_id, mrn_hash, age_group, total_encounters, latest_news2_risk
           FROM patient_summary ORDER BY patient_id;""",
    )


SUMMARY_ANSWER = (
    "patient_id", "gender", "age_years", "latest_spo2", "latest_news2_risk",
    "icu_admissions", "critical_labs_90d",
)


def summary_question(key: str, ask: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[key] = lambda t: ask(t.mart("patient_summary")).select(*SUMMARY_ANSWER)


summary_question("nl_icu_patients", questions.icu_patients)
summary_question("nl_critical_patients", questions.critical_patients)
summary_question("nl_high_risk_spo2", questions.high_risk_low_spo2)
summary_question("nl_female_over_60", questions.women_over_60)


@query
def nl_admissions_week(t: Tables) -> DataFrame:
    return questions.admissions_week(t.mart("daily_census"), CENSUS_AS_OF)


@query
def nl_risk_counts(t: Tables) -> DataFrame:
    return questions.risk_counts(t.mart("patient_summary"))


@query
def nl_note_search(t: Tables) -> DataFrame:
    found = questions.note_search(t.notes, t.mart("patient_summary"), NOTE_KEYWORD)
    return found.select("note_id", "patient_id", "authored_by", "gender", "latest_news2_risk")


@query
def nl_note_search_indexed(t: Tables) -> DataFrame:
    """The same notes by the posting lists of their trigrams."""
    index = TextIndex(t.spark, f"{run_folder(t.spark)}/notes", "note_id", "note_text")
    index.build(t.notes)
    found = questions.notes_with_patients(index.search(NOTE_KEYWORD), t.mart("patient_summary"))
    return found.select("note_id", "patient_id", "authored_by", "gender", "latest_news2_risk")


@query
def nl_notes_by_author(t: Tables) -> DataFrame:
    return questions.notes_by_author(t.notes)


# Retrieval -------------------------------------------------------------------------


def hits(vectors: DataFrame) -> DataFrame:
    """Every vector asked against every vector."""
    corpus = vectors.withColumnRenamed("vec_id", "note_id")
    asked = vectors.withColumnRenamed("vec_id", "query_id")
    return cosine_topk(corpus, asked)


def found_notes(t: Tables) -> DataFrame:
    return retrieval.hit_notes(hits(t.vectors), t.notes)


@query
def rag_note_text(t: Tables) -> DataFrame:
    return retrieval.note_text(t.notes).select("note_id", "embed_text")


@query
def rag_embed(t: Tables) -> DataFrame:
    texts = retrieval.note_text(t.notes)
    vectors = retrieval.embed(retrieval.fit_embedder(texts), texts)
    # As rows, since zeros are most of a vector.
    entries = vectors.select("note_id", F.posexplode("embedding").alias("bucket", "value")).filter("value <> 0")
    return entries.withColumn("value", F.round("value", 4).cast("decimal(7,4)"))


@query
def rag_cosine_topk(t: Tables) -> DataFrame:
    return hits(t.vectors).withColumn("score", F.round("score", 3))


@query
def rag_cosine_cells(t: Tables) -> DataFrame:
    """The same hits from a stored corpus, by the cells that a query's bounds admit."""
    folder = run_folder(t.spark)
    index = BallIndex(t.spark, f"{folder}/balls")
    index.build(t.vectors.withColumnRenamed("vec_id", "note_id"))
    found = index.search(t.vectors.withColumnRenamed("vec_id", "query_id"), f"{folder}/asked")
    return found.hits.withColumn("score", F.round("score", 3))


@query
def rag_topk_odd_vectors(t: Tables) -> DataFrame:
    """Some vectors are longer, some have an unknown or an undefined element, some are missing."""
    odd = t.vectors.withColumn(
        "embedding",
        F.expr(
            """CASE vec_id % 10 WHEN 0 THEN concat(embedding, array(cast(vec_id % 7 as float)))
               WHEN 1 THEN concat(array(cast(NULL as float)), slice(embedding, 2, size(embedding)))
               WHEN 2 THEN concat(array(float('NaN')), slice(embedding, 2, size(embedding)))
               WHEN 3 THEN NULL ELSE embedding END"""
        ),
    )
    return hits(odd).withColumn("score", F.round("score", 3))


@query
def rag_structured_ctx(t: Tables) -> DataFrame:
    corpus = retrieval.hit_patients(found_notes(t))
    path = f"{run_folder(t.spark)}/patients"
    corpus.write.parquet(path)
    return retrieval.structured_context(
        t.spark.read.parquet(path), t.mart("patient_summary"), t.mart("critical_alerts")
    )


@query
def rag_note_ctx(t: Tables) -> DataFrame:
    return retrieval.note_context(found_notes(t))


@query
def rag_notes_used(t: Tables) -> DataFrame:
    return retrieval.notes_used(found_notes(t))


@query
def rag_patient_ids(t: Tables) -> DataFrame:
    return retrieval.hit_patients(found_notes(t))


# Metrics and streaming -------------------------------------------------------------


@query
def met_topic_offsets(t: Tables) -> DataFrame:
    log = t.raw("events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return metrics.topic_offsets(log)


@query
def met_topic_health(t: Tables) -> DataFrame:
    log = t.raw("events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return metrics.topic_health(log, ["signup", "view", "never sent"])


@query
def met_stream_listener(t: Tables) -> DataFrame:
    """Figures of a finished stream that do not depend on time or batches."""
    folder, table = run_folder(t.spark), SOURCE_TABLES["lab_results"]
    listener = MetricsListener()
    t.spark.streams.addListener(listener)
    try:
        running = write_bronze_batches(landing(t, folder, [table.name]), table, folder, every=None)
        await_all([running])
        listener.wait_for_end([running])
    finally:
        t.spark.streams.removeListener(listener)
    listener.flush(t.spark, f"{folder}/metrics")
    rows = t.spark.read.parquet(f"{folder}/metrics")
    fixed = ("num_input_rows", "records_read", "tombstones", "records_without_key")
    return rows.filter(F.col("metric").isin(*fixed)).groupBy("entity", "metric").agg(F.sum("value").alias("value"))


@query
def met_layer_health(t: Tables) -> DataFrame:
    now = F.expr(f"timestamp'{AS_OF} 00:12:00'")
    return metrics.layer_health(t.marts, t.bronze, now)


@query
def met_published_health(t: Tables) -> DataFrame:
    """The same figures of two published marts, from what their commits tell."""
    folder, at = run_folder(t.spark), dt.datetime.fromisoformat(f"{AS_OF}T00:00:00+00:00")
    SplitTable(t.spark, f"{folder}/gold/encounter_metrics", "event_id").merge(t.mart("encounter_metrics"), stamp={"gold_computed_at": at})
    CommittedTable(t.spark, f"{folder}/gold/daily_census").publish(t.marts["daily_census"])
    now = F.expr(f"timestamp'{AS_OF} 00:12:00'")
    return metrics.published_health(t.spark, folder, ["encounter_metrics", "daily_census", "never_built"], now)


@query
def str_bronze_multi(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    names = list(SOURCE_TABLES)
    await_all(start_bronze(landing(t, folder, names), folder, every=None))
    return union(
        [
            read_bronze(t.spark, folder, name).select(
                "source_table", F.col(SOURCE_TABLES[name].key).alias("row_key"), OP
            )
            for name in names
        ]
    )


@query
def str_rate_limit(t: Tables) -> DataFrame:
    folder, table = run_folder(t.spark), SOURCE_TABLES["adt_events"]
    # A batch is one file, whatever its size: not compressed, several tasks share it.
    landing(t, folder, ["adt_events"], compression="none", maxRecordsPerFile=0)
    limited = read_landing(t.spark, f"{folder}/landing/adt_events", [table.topic], files_per_trigger=1)
    await_all([write_bronze_batches(lambda _: limited, table, folder, every=None)])
    rows = read_bronze(t.spark, folder, "adt_events")
    # A batch has the records of one file: those that one writer was given.
    files = t.spark.read.json(f"{folder}/landing/adt_events").select(F.input_file_name().alias("file"))
    of_files = files.groupBy("file").count().groupBy(F.col("count").alias("batch_rows")).agg(F.count(F.lit(1)).alias("files"))
    of_batches = rows.groupBy("batch_id").count().groupBy(F.col("count").alias("batch_rows")).agg(F.count(F.lit(1)).alias("batches"))
    odd = of_files.join(of_batches, "batch_rows", "full").filter("files IS DISTINCT FROM batches").count()
    return rows.select("event_id", F.lit(odd).cast("int").alias("batches_not_of_one_file"))


@query
def str_record_limit(t: Tables) -> DataFrame:
    """A captured log in batches of at most 500 records, from several partitions: all rows once, and the largest batch."""
    folder, table = run_folder(t.spark), SOURCE_TABLES["adt_events"]
    records = change_records(t)["adt_events"].withColumn("partition", (F.col("offset") * 7 % 11 % 3).cast("int"))
    records.write.parquet(f"{folder}/log")
    limit = 500
    log = t.spark.read.parquet(f"{folder}/log")
    write_limited_batches(t.spark, log, table, folder, limit, batches=2)
    write_limited_batches(t.spark, log, table, folder, limit)
    rows = read_bronze(t.spark, folder, "adt_events")
    largest = rows.groupBy("batch_id").count().agg(F.max("count")).first()[0]
    return rows.select("event_id", F.lit(largest <= limit).alias("within_limit"))


@query
def str_silver_upsert(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    await_all([append_bronze(landing(t, folder, ["vitals"]), VITALS, folder, every=None)])
    await_all([merge_bronze(t.spark, folder, VITALS, AS_OF)])
    rows = read_silver(t.spark, folder, "vitals")
    return rows.select(
        "vital_id", "patient_id", "heart_rate", "spo2", "recorded_at", "news2_score", "alert_flags"
    )


@query
def pipe_run(t: Tables) -> DataFrame:
    folder = run_folder(t.spark)
    await_all(start_bronze(landing(t, folder, list(SOURCE_TABLES)), folder, every=None))
    run_pipeline(t.spark, folder, AS_OF)
    return read_table(t.spark, "patient_summary", [f"{folder}/gold"]).drop("gold_computed_at")


BATCHES = 3
# What is compared of each mart: three names and four figures of a row.
MART_ROWS = {
    "patient_summary": "patient_id, gender, latest_news2_risk, total_encounters, latest_hr, lab_count_90d, icu_admissions",
    "encounter_metrics": "event_id, ward, news2_risk, vital_count, max_hr, min_spo2, max_news2_score",
    "daily_census": "event_date, ward, event_type, event_count, NULL, NULL, NULL",
    "critical_alerts": "result_id, gender, test_code, age_years, result_numeric, NULL, NULL",
    "quality_dashboard": "metric_date, NULL, NULL, lab_count, vital_count, alert_count, abnormal_count",
    "lab_turnaround": "metric_date, test_code, NULL, result_count, min_minutes, max_minutes, NULL",
}


@query
def pipe_changes(t: Tables) -> DataFrame:
    """All marts after three runs, each of a third of the changes, later versions and deletes among them."""
    folder = run_folder(t.spark)
    records = change_records(t, writers=t.spark.sparkContext.defaultParallelism)
    for batch in range(BATCHES):
        for name, frame in records.items():
            frame.where(F.pmod("offset", F.lit(BATCHES)) == batch).write.options(**LANDED).json(f"{folder}/landing/{name}/batch={batch}")
        await_all(start_bronze(lambda table: read_landing(t.spark, f"{folder}/landing/{table.name}", [table.topic]), folder, every=None))
        run_pipeline(t.spark, folder, AS_OF)
    rows = []
    for mart, columns in MART_ROWS.items():
        names = columns.split(", ")
        chosen = [f"cast({c} as string) AS k{i}" for i, c in enumerate(names[:3], 1)]
        chosen += [f"cast({c} as double) AS n{i}" for i, c in enumerate(names[3:], 1)]
        frame = read_table(t.spark, mart, [f"{folder}/gold"])
        if mart == "quality_dashboard":  # patients count on the day of the run
            frame = frame.where("lab_count IS NOT NULL OR vital_count IS NOT NULL")
        rows.append(frame.selectExpr(f"'{mart}' AS mart", *chosen))
    return union(rows)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plain_times(build(Tables(spark, folder)))

    return {name: runner(build) for name, build in QUERIES.items()}
