import datetime as dt

from helpers import NOON, rows_by
from pyspark.sql import functions as F

from checks.adapters import Tables
from wardlake.plans import metrics
from wardlake.session import SCAN_BYTES, SCAN_OPTION


def test_topic_offsets(frame):
    log = frame([("a", 0, 3), ("a", 0, 9), ("a", 1, 0), ("b", 0, 5)], "topic STRING, partition INT, offset BIGINT")
    found = {(r.topic, r.partition): (r.earliest_offset, r.latest_offset, r.total_messages) for r in metrics.topic_offsets(log).collect()}
    assert found == {("a", 0): (3, 10, 7), ("a", 1): (0, 1, 1), ("b", 0): (5, 6, 1)}
    totals = rows_by(metrics.topic_totals(log), "topic")
    assert (totals["a"].latest_offset, totals["a"].total_messages) == (11, 8)


def aged(frame, minutes):
    at = NOON - dt.timedelta(minutes=minutes)
    return frame([(1, at)], "x INT, gold_computed_at TIMESTAMP")


def test_freshness_edges(frame):
    gold = {"fresh": aged(frame, 29.9), "old": aged(frame, 30), "bare": frame([(1,), (2,)], "x INT"),
            "empty": aged(frame, 1).filter("x > 1")}
    health = rows_by(metrics.layer_health(gold, {"patients": frame([(1,)], "x INT")}, NOON), "table_name")
    assert {n: (r.row_count, r.age_minutes, r.status) for n, r in health.items()} == {
        "fresh": (1, 29.9, "ok"),
        "old": (1, 30.0, "stale"),
        "bare": (2, -1.0, "unknown"),
        "empty": (0, -1.0, "unknown"),
        "patients": (1, -1.0, "ok"),
    }


def test_metric_rows(frame):
    health = metrics.layer_health({"mart": aged(frame, 5)}, now=F.lit(NOON))
    rows = metrics.as_metric_rows(health, NOON).collect()
    assert [(r.entity, r.metric, r.value, r.tag) for r in rows] == [
        ("gold.mart", "row_count", 1.0, "ok"), ("gold.mart", "age_minutes", 5.0, "ok")]


def test_no_task_of_a_query_reads_more_than_a_bounded_part_of_a_file(spark):
    before = spark.conf.get(SCAN_OPTION)
    try:
        for given, expected in (("128m", str(SCAN_BYTES)), ("16m", "16m")):
            spark.conf.set(SCAN_OPTION, given)
            assert Tables(spark, "/root/testdata/sf0.001").spark.conf.get(SCAN_OPTION) == expected
    finally:
        spark.conf.set(SCAN_OPTION, before)
