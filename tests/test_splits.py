"""Keyed tables that write only what changes: rows, files, feeds, folding."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlake.operators.merge import merge_changes
from wardlake.sources import splits
from wardlake.sources.splits import SplitTable

ROW = "k LONG, v STRING, cdc_op STRING, ver INT"


def rows_of(spark, rows):
    return spark.createDataFrame([(k, v, "c", n) for k, v, n in rows], ROW)


def content(table):
    return {r.k: r.v for r in table.read().collect()}


def data_rows(spark, table):
    return spark.read.schema(ROW).parquet(f"{table.root}/{table.newest()}/data").count()


def test_a_merge_writes_only_the_changes(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    table.merge(rows_of(spark, [(k, "a", 1) for k in range(5000)]), newest_by=["ver"])
    table.merge(rows_of(spark, [(11, "b", 2), (12, "late", 0), (7000, "new", 1), (None, "x", 1)]), newest_by=["ver"])
    assert data_rows(spark, table) == 2
    files, _ = table.manifest()
    assert [(f.rows, f.marked) for f in sorted(files, key=lambda f: -f.rows)] == [(5000, 1), (2, 0)]
    feed = {r.new.k: r.old and r.old.v for r in table.feed(0).collect()}
    assert feed == {11: "a", 7000: None}
    assert content(table) == {k: "b" if k == 11 else "a" for k in range(5000)} | {7000: "new"}
    table.merge(rows_of(spark, [(11, "b", 2)]), newest_by=["ver"])  # comes twice
    assert data_rows(spark, table) == 0 and table.feed(1).count() == 0 and table.feed(0).count() == 2
    before = content(table)
    assert table.fold() and not table.fold()
    assert content(table) == before and [f.marked for f in table.manifest()[0]] == [0]


def test_readers_open_only_files_that_may_hold_the_keys(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k", split_bytes=20_000)
    words = random.Random(1)
    table.merge(rows_of(spark, [(k, f"{words.random()}", 1) for k in range(6000)]), newest_by=["ver"])
    files, _ = table.manifest()
    assert len(files) > 4
    # Places are read from one listing of names and one manifest, whatever the number of commits.
    some = table.read_between([(100, 120), (5990, 9000)])
    assert sorted(r.k for r in some.collect()) == [*range(100, 121), *range(5990, 6000)]
    assert len(some.inputFiles()) == 2
    keys = spark.createDataFrame([(5,), (6,), (None,), (99999,)], "id LONG")
    assert sorted(r.k for r in table.read_for(keys).collect()) == [5, 6]
    table.merge(rows_of(spark, [(5, "z", 2)]), newest_by=["ver"])
    assert {r.k: r.v for r in table.read_between([(4, 5)]).collect()}[5] == "z"


@pytest.mark.parametrize("scale", [1, 4])
def test_files_follow_the_size_of_the_table(spark, tmp_path, scale):
    limit, words = 30_000, random.Random(2)
    table = SplitTable(spark, str(tmp_path / "t"), "k", split_bytes=limit, most_files=3)
    keys = 0
    for _ in range(5):
        batch = [(k, f"{words.random()}", 1) for k in range(keys, keys + 1500 * scale)]
        batch += [(words.randrange(keys + 1), f"{words.random()}", keys + 2) for _ in range(20)]
        keys += 1500 * scale
        table.merge(rows_of(spark, batch).repartition(16), newest_by=["ver"])
    files, _ = table.manifest()
    total, splits = sum(f.bytes for f in files), {f.split for f in files}
    assert sum(f.rows - f.marked for f in files) == keys == len(content(table))
    assert len(splits) <= 3 * total / limit + 1 and len(files) <= 3 * len(splits)
    assert max(f.bytes for f in files) < 2.5 * limit
    # Splits lie side by side and leave no key out.
    bounds = sorted({(f.low is not None, f.low or 0, f.high) for f in files})
    assert bounds[0][0] is False and bounds[-1][2] is None
    assert all(a[2] == b[1] for a, b in zip(bounds, bounds[1:]))


def test_merge_clauses(spark, tmp_path):
    target = spark.createDataFrame([(k, "t", "c") for k in range(10)], "k LONG, v STRING, op STRING")
    source = spark.createDataFrame(
        [(1, "s", "u"), (2, "s", "d"), (3, "s", None), (20, "s", "c"), (21, "s", "d"), (22, "s", None)], target.schema
    )
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    table.merge(target)
    table.merge(source, op="op")
    expected = {tuple(r) for r in merge_changes(target, source, "k", op="op").collect()}
    assert {tuple(r) for r in table.read().collect()} == expected
    assert {r.old.k for r in table.feed(0).where("new IS NULL").collect()} == {2}
    table.merge(source.withColumn("op", F.lit("d")), op="op", keep_op=True)
    assert {r.k for r in table.read().collect()} == {0, *range(4, 10)}


def test_new_columns_far_keys_and_empty_merges(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k", split_bytes=1000)
    assert table.read() is None and table.feed(-1) is None and table.number() == -1
    table.merge(rows_of(spark, []), newest_by=["ver"])
    assert table.read().count() == 0
    far = [-(1 << 63), -5, 0, 7, (1 << 53) + 1, (1 << 53) + 2, (1 << 63) - 1]
    table.merge(rows_of(spark, [(k, "a" * 400, 1) for k in far]), newest_by=["ver"])
    wider = rows_of(spark, [(7, "b", 2), ((1 << 53) + 1, "b", 2)]).withColumn("extra", F.lit(7))
    table.merge(wider, newest_by=["ver"])
    table.merge(rows_of(spark, [(0, "c", 3)]), newest_by=["ver"])
    found = {r.k: (r.v[:1], r.extra) for r in table.read().collect()}
    expected = {k: ("a", None) for k in far} | {7: ("b", 7), (1 << 53) + 1: ("b", 7), 0: ("c", None)}
    assert found == expected


def test_commits_that_failed_or_come_again(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    assert table.merge(rows_of(spark, [(1, "a", 1)]), "x-1", ["ver"])
    assert not table.merge(rows_of(spark, [(1, "b", 2)]), "x-1", ["ver"])
    (tmp_path / "t" / "commit=0000000001.x-2" / "data").mkdir(parents=True)
    assert content(table) == {1: "a"} and not table.has("x-2")
    assert table.merge(rows_of(spark, [(1, "c", 3)]), "x-2", ["ver"])
    assert content(table) == {1: "c"} and table.number() == 2
    assert table.drop_superseded(keep=0, after=2) == ["commit=0000000000.x-1", "commit=0000000001.x-2"]
    assert content(table) == {1: "c"} and table.feed(0) is None
    assert table.feed(2).count() == 0


def test_a_stamp_is_shown_by_all_rows(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    table.merge(rows_of(spark, [(1, "a", 1)]), stamp={"at": dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)})
    table.merge(rows_of(spark, [(2, "a", 1)]), stamp={"at": dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)})
    assert [r[0] for r in table.read().select(F.date_format("at", "yyyy-MM-dd")).distinct().collect()] == ["2024-01-02"]
    table.merge(rows_of(spark, [(3, "a", 1)]), start_anew=True)
    assert content(table) == {3: "a"} and table.feed(0) is None


def test_a_first_commit_is_dealt_out_by_ranges_and_written_once(spark, tmp_path):
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    rows = spark.range(400_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("c").alias("cdc_op"), F.lit(1).alias("ver"))
    table.merge(rows, newest_by=["ver"])
    files = sorted(table.manifest()[0], key=lambda f: f.least)
    assert len(files) > 1 and len({f.split for f in files}) <= len(files)
    assert all(a.greatest < b.least for a, b in zip(files, files[1:]))
    assert sum(f.rows for f in files) == 400_000 == table.read().count()
    bounds = sorted({(f.low is not None, f.low or 0, f.high) for f in files})
    assert bounds[0][0] is False and bounds[-1][2] is None and all(a[2] == b[1] for a, b in zip(bounds, bounds[1:]))


def test_rows_of_a_first_commit_meet_in_ranges_unless_a_key_is_hot(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splits, "LEAST_HOT", 100)
    table = SplitTable(spark, str(tmp_path / "t"), "k")
    even = rows_of(spark, [(k % 500, "a", k) for k in range(1000)] + [(None, "x", 1)])
    assert table.ranges_for_first(rows_of(spark, [(7 if k % 3 else k, "a", k) for k in range(1000)])) is None
    table.merge(table.ranges_for_first(even), newest_by=["ver"], ranged=True)
    assert {r.k: r.ver for r in table.read().collect()} == {k: k + 500 for k in range(500)}
    assert table.ranges_for_first(even) is None  # the table has rows to meet
