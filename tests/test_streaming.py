"""The change stream on landing files: sinks, restart, replay, late changes, the whole run."""

import shutil

import pytest
from helpers import MICROS, PATIENTS, SEED_DAY, VITALS, land, record, rows_by, seed_records
from pyspark.sql import functions as F

from wardlake.operators.merge import OP
from wardlake.schemas import CHANGE_RECORD, SOURCE_TABLES, VITALS as VITALS_TABLE
from wardlake.sources.evolution import fields_of, rescued_fields, with_more_fields
from wardlake.sources.changes import admitted, all_waiting, in_batches, kafka_options, read_kafka, read_landing
from wardlake.sources.tables import TableNotFound, jdbc_options, read_table, register_views
from wardlake.sources.splits import SplitTable
from wardlake.sources.versioned import CommittedTable
from wardlake.streaming.bronze import (
    append_bronze,
    await_all,
    batch_writer,
    read_bronze,
    read_dead_letters,
    start_bronze,
    write_bronze_batches,
    write_limited_batches,
)
from wardlake.streaming.listener import MetricsListener
from wardlake.streaming.pipeline import run_pipeline
from wardlake.streaming.silver import merge_bronze, read_silver, rebuild_silver, silver_table

LAYOUT = {"split_bytes": 4_000}


def source(spark, folder, files=None):
    return lambda table: read_landing(spark, str(folder), [table.topic], files)


def messy():
    return [
        record("vitals", VITALS[0], 0),
        record("vitals", {**VITALS[0], "heart_rate": 140}, 1),
        record("vitals", None, 2),
        record("vitals", "{broken", 3),
        record("patients", PATIENTS[0], 0),
    ]


@pytest.mark.parametrize("sink", [append_bronze, write_bronze_batches])
def test_bronze_sinks(spark, tmp_path, sink):
    land(tmp_path / "in", "1", messy())
    base = str(tmp_path / "lake")
    await_all([sink(source(spark, tmp_path / "in"), VITALS_TABLE, base, every=None)])
    await_all([sink(source(spark, tmp_path / "in"), VITALS_TABLE, base, every=None)])  # restart
    land(tmp_path / "in", "2", [record("vitals", VITALS[1], 4, deleted="true")])
    await_all([sink(source(spark, tmp_path / "in"), VITALS_TABLE, base, every=None)])
    rows = {r.kafka_offset: r for r in read_bronze(spark, base, "vitals").collect()}
    assert set(rows) == {0, 1, 4}
    assert rows[1].alert_flags == "TACHYCARDIA" and rows[0][OP] == "c" and rows[4][OP] == "d"


@pytest.mark.parametrize("sink", [append_bronze, write_bronze_batches])
def test_what_is_read_is_kept_or_a_dead_letter_or_a_tombstone(spark, tmp_path, sink):
    base, listener = str(tmp_path / "lake"), MetricsListener()
    bad = ['{"patient_id": 7, "ssn": "123-45-6789", "phone": "555', "[1, 2]", '"text"', "", '{"mrn": "M-1", "email": null}', '{"patient_id": "x"}']
    records = [record("patients", p, n) for n, p in enumerate(PATIENTS)]
    records += [record("patients", value, 100 + n) for n, value in enumerate(bad)] + [record("patients", None, 200)]
    land(tmp_path / "in", "1", records)
    spark.streams.addListener(listener)
    try:
        query = sink(source(spark, tmp_path / "in"), SOURCE_TABLES["patients"], base, every=None)
        await_all([query])
        assert listener.wait_for_end([query])
    finally:
        spark.streams.removeListener(listener)
    letters = {r.offset: r for r in read_dead_letters(spark, base, "patients").collect()}
    assert {n: r.cause for n, r in letters.items()} == {
        100: "not a JSON object", 101: "not a JSON object", 102: "not a JSON object", 103: "not a JSON object", 104: "no key", 105: "no key",
    }
    assert {r.topic for r in letters.values()} == {"ehr.public.patients"}
    assert letters[100].value == '{"patient_id": 7, "ssn":"***", "phone":"***"' and letters[104].value == '{"mrn":"***", "email":"***"}'
    figures = {r[2]: r[3] for r in listener.rows() if r[2] in ("records_read", "tombstones") and r[4] == "0"}
    assert figures["records_read"] == read_bronze(spark, base, "patients").count() + len(letters) + figures["tombstones"]


def test_new_fields_become_columns_while_the_stream_runs(spark, tmp_path):
    base, table = str(tmp_path / "lake"), SOURCE_TABLES["vitals"]
    extra = [{}, {"pain": 3, "note": "a"}, {"pain": 2.5, "ward_phone": "555"}, {"pain": "bad", "pipeline_ts": "x", "a b": 1}]
    for n, fields in enumerate(extra):
        land(tmp_path / "in", str(n), [record("vitals", {**VITALS[0], "vital_id": n, **fields}, n)])
        if n in (0, 1, 2):
            await_all([append_bronze(source(spark, tmp_path / "in", files=1), table, base, every=None)])
            await_all([merge_bronze(spark, base, table, SEED_DAY)])
        if n == 1:
            assert dict(read_bronze(spark, base, "vitals").dtypes)["pain"] == "bigint"
    assert dict(read_bronze(spark, base, "vitals").dtypes)["pain"] == "double"
    await_all([append_bronze(source(spark, tmp_path / "in", files=1), table, base, every=None)])
    await_all([merge_bronze(spark, base, table, SEED_DAY)])
    rows = rows_by(read_bronze(spark, base, "vitals"), "vital_id")
    assert [rows[n].pain for n in range(4)] == [None, "3", "2.5", "bad"] and rows[1].note == "a"
    assert rows[3].rescued == {"pipeline_ts": "x", "a b": "1"} and rows[0].rescued is None
    assert rows[2].ward_phone not in (None, "555")  # masked by its name


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    write = batch_writer(str(tmp_path / "t"))
    write(spark.range(3), 7)
    write(spark.range(3), 7)
    write(spark.range(0), 8)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_a_failing_batch_is_raised(spark, tmp_path):
    land(tmp_path / "in", "1", messy())
    (tmp_path / "lake" / "bronze").mkdir(parents=True)
    (tmp_path / "lake" / "bronze" / "vitals").write_text("a file where a folder is needed")
    with pytest.raises(Exception):
        await_all([write_bronze_batches(source(spark, tmp_path / "in"), VITALS_TABLE, str(tmp_path / "lake"), every=None)])


def test_records_are_admitted_by_topic(spark, tmp_path):
    rows = [("a", p, 10 * n + p) for p, count in ((0, 50), (1, 9), (2, 1)) for n in range(count)] + [("b", 0, n) for n in range(4)]
    log = spark.createDataFrame(rows, "topic STRING, partition INT, offset LONG")
    done, after, rounds = set(), {}, []
    while True:
        known = spark.createDataFrame([(t, p, o) for (t, p), o in after.items()], "topic STRING, partition INT, to_offset LONG")
        found = admitted(log, known, 12).collect()
        if not found:
            break
        rounds.append({(r.topic, r.partition): r.records for r in found})
        for r in found:
            taken = {x for x in rows if x[:2] == (r.topic, r.partition) and r.from_offset <= x[2] <= r.to_offset}
            assert len(taken) == r.records and not taken & done
            done |= taken
            after[r.topic, r.partition] = r.to_offset
    assert done == set(rows) and len(rounds) == 5
    assert all(sum(n for (t, _), n in r.items() if t == "a") == 12 for r in rounds) and rounds[0]["b", 0] == 4


def test_files_per_trigger_limits_batches(spark, tmp_path):
    for i in range(3):
        land(tmp_path / "in", str(i), [record("vitals", {**VITALS[0], "vital_id": i}, i)])
    query = write_bronze_batches(source(spark, tmp_path / "in", files=1), VITALS_TABLE, str(tmp_path / "lake"), every=None)
    await_all([query])
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_listener(spark, tmp_path):
    land(tmp_path / "in", "1", messy())
    listener = MetricsListener()
    spark.streams.addListener(listener)
    try:
        query = append_bronze(source(spark, tmp_path / "in"), VITALS_TABLE, str(tmp_path / "lake"), every=None)
        await_all([query])
        assert listener.wait_for_end([query])
    finally:
        spark.streams.removeListener(listener)
    written = listener.flush(spark, str(tmp_path / "metrics"))
    rows = spark.read.parquet(str(tmp_path / "metrics")).collect()
    assert written == len(rows) and listener.rows() == []
    found = {r.metric: r.value for r in rows if r.entity == "bronze_vitals" and r.tag == "0" and r.metric != "active"}
    assert {"input_rows_per_sec", "processed_rows_per_sec", "trigger_ms"} <= set(found)
    assert (found["num_input_rows"], found["records_read"], found["tombstones"], found["records_without_key"]) == (4, 4, 1, 2)
    assert [r.value for r in rows if r.metric == "active"][-1] == 0


def test_silver_follows_the_log(spark, tmp_path):
    base = str(tmp_path / "lake")

    def run(name, records):
        land(tmp_path / "in", name, records)
        await_all([append_bronze(source(spark, tmp_path / "in"), VITALS_TABLE, base, every=None)])
        await_all([merge_bronze(spark, base, VITALS_TABLE, SEED_DAY, **LAYOUT)])
        return {k: r.heart_rate for k, r in rows_by(read_silver(spark, base, "vitals"), "vital_id").items()}

    first = [record("vitals", v, i) for i, v in enumerate(VITALS)]
    assert run("1", first) == {1: 102.0, 2: 118.0, 3: 78.0, 4: 88.0, 5: 95.0}
    changes = [
        record("vitals", {**VITALS[0], "heart_rate": 60}, 10),
        record("vitals", {"vital_id": 2}, 11, deleted="true"),
        record("vitals", None, 12),
        record("vitals", {**VITALS[2], "heart_rate": 71}, 14),
        record("vitals", {**VITALS[2], "heart_rate": 70}, 13),
    ]
    assert run("2", changes) == {1: 60.0, 3: 71.0, 4: 88.0, 5: 95.0}
    assert run("3", [record("vitals", {**VITALS[1], "heart_rate": 99}, 15)])[2] == 99.0
    silver = silver_table(spark, base, "vitals")
    assert silver.number() == 2 and silver.newest().endswith("-2")


@pytest.mark.parametrize("sink", [append_bronze, write_bronze_batches])
def test_rebuild_equals_the_stream(spark, tmp_path, sink):
    base = str(tmp_path / "lake")
    land(tmp_path / "in", "1", messy())
    await_all([sink(source(spark, tmp_path / "in"), VITALS_TABLE, base, every=None)])
    await_all([merge_bronze(spark, base, VITALS_TABLE, SEED_DAY, **LAYOUT)])
    target = SplitTable(spark, str(tmp_path / "again"), "vital_id")
    rebuild_silver(spark, read_bronze(spark, base, "vitals"), target, VITALS_TABLE, SEED_DAY)
    columns = ["vital_id", "heart_rate", "alert_flags", "news2_score", "kafka_offset"]
    streamed = silver_table(spark, base, "vitals").read()
    assert target.read().select(columns).collect() == streamed.select(columns).collect()
    assert streamed.count() == 1


def test_whole_run(spark, tmp_path):
    base = str(tmp_path / "lake")
    land(tmp_path / "in", "1", seed_records())
    await_all(start_bronze(source(spark, tmp_path / "in"), base, every=None))
    assert run_pipeline(spark, base, SEED_DAY, silver_only=True, **LAYOUT) == []
    with pytest.raises(TableNotFound):
        read_table(spark, "patient_summary", [f"{base}/gold"])
    assert len(run_pipeline(spark, base, SEED_DAY, keep=1, **LAYOUT)) == 6
    land(tmp_path / "in", "2", [record("patients", {"patient_id": 3}, 9, deleted="true")])
    await_all(start_bronze(source(spark, tmp_path / "in"), base, every=None))
    run_pipeline(spark, base, "2033-11-15", keep=1, **LAYOUT)
    people = rows_by(read_table(spark, "patient_summary", [f"{base}/nowhere", f"{base}/gold"]), "patient_id")
    assert set(people) == {1, 2, 4, 5}
    assert people[4].age_group == "ADULT"  # ten years on, without a change of the row
    registered = register_views(spark, ["patient_summary", "daily_census", "absent"], [f"{base}/gold"])
    assert registered == ["patient_summary", "daily_census"]
    assert spark.sql("SELECT count(*) FROM daily_census").first()[0] == 4
    assert len(CommittedTable(spark, f"{base}/gold/daily_census").commits()) == 1


def test_gold_is_not_built_on_a_failed_silver(spark, tmp_path):
    base = str(tmp_path / "lake")
    with pytest.raises(Exception):
        run_pipeline(spark, base, SEED_DAY, **LAYOUT)
    assert not (tmp_path / "lake" / "gold").exists()


def test_read_table_raises_what_is_not_a_missing_path(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        read_table(spark, "t", [str(tmp_path)]).count()
    assert not isinstance(error.value, TableNotFound)


def test_source_options(spark):
    options = kafka_options("broker:9092", [t.topic for t in SOURCE_TABLES.values()])
    assert options["subscribe"].count(",") == 3 and options["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in options
    single = kafka_options("b", ["t"], "latest", 500)
    assert single["maxOffsetsPerTrigger"] == "500" and single["failOnDataLoss"] == "false"
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "broker:9092", ["t"])
    notes = jdbc_options("jdbc:x:y", bounds=(1, 10), partitions=4, user="u")
    assert notes["partitionColumn"] == "note_id" and notes["numPartitions"] == "4" and notes["user"] == "u"
    assert "partitionColumn" not in jdbc_options("jdbc:x:y")


def test_seed_time():
    assert MICROS // 1_000_000 == 1_700_000_000


def test_batches_of_a_log_mix_its_partitions(spark):
    rows = [("a", p, 10 * n + p) for p, count in ((0, 50), (1, 9), (2, 1)) for n in range(count)] + [("b", 0, n) for n in range(4)]
    log = spark.createDataFrame(rows, "topic STRING, partition INT, offset LONG")
    ranges = all_waiting(log, spark.createDataFrame([("a", 0, 99)], "topic STRING, partition INT, to_offset LONG"))
    found = in_batches(log, ranges, 7, bin_records=8).collect()
    left = [r for r in rows if not (r[:2] == ("a", 0) and r[2] <= 99)]
    assert sorted(r[:3] for r in found) == sorted(left)
    own = {p: sorted((r.offset, r.batch) for r in found if (r.topic, r.partition) == ("a", p)) for p in range(3)}
    sizes = [sum(b == at for o in own.values() for _, b in o) for at in range(8)]
    assert sizes == [7] * 7 + [1] and all([b for _, b in o] == sorted(b for _, b in o) for o in own.values())
    assert {sum(b == at for _, b in own[1]) for at in range(7)} == {1, 2}


def test_limited_batches_take_one_job_and_replace_what_failed(spark, tmp_path):
    rows = [record("vitals", {**VITALS[0], "vital_id": i}, i) for i in range(40)]
    land(tmp_path / "in", "1", rows)
    log = spark.read.schema(CHANGE_RECORD).json(str(tmp_path / "in"))
    base, folder = str(tmp_path / "lake"), tmp_path / "lake" / "bronze" / "vitals"
    assert write_limited_batches(spark, log, VITALS_TABLE, base, 3, batches=2) == 2
    # A try that failed after it had written its batches.
    shutil.copytree(folder / "batch_id=1", folder / "batch_id=5")
    assert write_limited_batches(spark, log, VITALS_TABLE, base, 3) == 12
    found = spark.read.parquet(str(folder)).groupBy("batch_id").count().collect()
    assert sorted((r.batch_id, r["count"]) for r in found) == [(i, 3) for i in range(13)] + [(13, 1)]
    assert spark.read.parquet(str(folder)).select("vital_id").distinct().count() == 40
    assert write_limited_batches(spark, log, VITALS_TABLE, base, 3) == 0
    # As many commits as calls that wrote, not as batches.
    assert spark.read.parquet(f"{base}/_ledger/bronze_vitals").select("commit").distinct().count() == 2


def test_all_fields_are_taken_only_where_there_are_more(spark):
    values = [
        '{"a": 1, "b": "x"}', '{"a": 1}', "{}", '{"a": 1, "c": [1, {"d": 2}]}', '{"a": 1, "c": null}', "{'a': 1}", '{"a": 1', '{"a": 1}, x',
        '[{"a": 1}]', "[1]", "1", '"a"', "null", "", " ", "text", '{"a": "line\nbreak"}', '{\n"a": 1\n}', '{"a": NaN}', '{"a": {"b": "x\ty"}}', '{"a": 1, "a": 2}', None,
    ]
    rows = with_more_fields(spark.createDataFrame([(v,) for v in values], "value string"), ["a", "b"])
    wanted = fields_of("value")
    others = lambda of: rescued_fields(of, ["a", "b"])
    found = rows.select(
        "value", "_fields", (F.col("_more") & F.col("_fields").isNull()).alias("is_none"), wanted.isNull().alias("none"),
        others(F.col("_fields")).alias("rescued"), others(wanted).alias("all_rescued"),
    ).collect()
    for r in found:
        assert r.is_none == r.none and r.rescued == r.all_rescued, r.value
    assert [r._fields for r in found[:3]] == [None] * 3
