import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlake.operators.dedupe import latest_per_key
from wardlake.operators.joins import join_unique
from wardlake.operators.merge import change_op, live_rows, merge_changes, merge_into
from wardlake.operators.vectors import RANK_DIGITS, Asked, Held, _top_of_cell, cosine_topk, left_out, unit
from wardlake.sources.splits import SplitTable
from wardlake.sources.versioned import CommittedTable

ROW = "k INT, v STRING, cdc_op STRING, pipeline_ts INT, kafka_offset INT"


def state(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


# Dedupe ------------------------------------------------------------------------------


def test_latest_breaks_ties_by_the_last_column(frame):
    df = frame([(1, "a", "c", 5, 1), (1, "b", "c", 5, 2), (1, "c", "c", 4, 9), (2, "d", "c", None, 1)], ROW)
    assert state(latest_per_key(df, "k", ["pipeline_ts", "kafka_offset"])) == [(1, "b"), (2, "d")]


def test_latest_limits_groups_before_the_shuffle(frame):
    df = frame([(1, "a", "c", 1, 1)], ROW)
    plan = latest_per_key(df, "k", ["pipeline_ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# Merge -------------------------------------------------------------------------------


def test_merge_clauses(frame):
    target = frame([(1, "old"), (2, "old"), (3, "old"), (None, "keyless")], "k INT, v STRING")
    source = frame(
        [(1, "new", "u"), (2, None, "d"), (3, "ignored", None), (4, "gone", "d"), (5, "late", "u"),
         (6, "new", "c"), (None, "keyless 2", "c")],
        "k INT, v STRING, cdc_op STRING",
    )
    target = target.withColumn("cdc_op", F.lit("c"))
    merged = merge_changes(target, source, "k")
    assert state(merged) == sorted(
        [(1, "new"), (3, "old"), (5, "late"), (6, "new"), (None, "keyless"), (None, "keyless 2")],
        key=str,
    )
    changed = source.filter("k is not null")
    assert state(merge_changes(merged, changed, "k")) == state(merged)


def test_merge_creates_without_deletes(frame):
    source = frame([(1, "a", "c"), (2, "b", "d")], "k INT, v STRING, cdc_op STRING")
    assert state(merge_changes(None, source, "k")) == [(1, "a")]


def test_merge_into_needs_a_format_with_row_level_operations(spark, frame):
    frame([(1, "a", "c")], "k INT, v STRING, cdc_op STRING").write.saveAsTable("plain", mode="overwrite")
    try:
        with pytest.raises(Exception, match="(?i)MERGE"):
            merge_into(frame([(1, "b", "u")], "k INT, v STRING, cdc_op STRING"), "plain", "k")
    finally:
        spark.sql("DROP TABLE plain")


def test_change_op(frame):
    df = frame([("u", "true"), (None, "true"), (None, "false"), (None, None)], "__op STRING, __deleted STRING")
    assert [r[0] for r in df.select(change_op(df.columns)).collect()] == ["u", "d", "c", "c"]
    assert [r[0] for r in df.select(change_op([])).collect()] == ["c"] * 4


LOG = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from("cud"), st.integers(0, 3)), min_size=1, max_size=25
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=LOG)
def test_batches_of_changes_equal_a_row_by_row_fold(spark, tmp_path_factory, log):
    """A change log applied batch by batch, in any cut, gives the state of a simple fold."""
    folded = {}
    batches = {}
    for offset, (key, op, cut) in enumerate(log):
        batches.setdefault(cut, []).append((key, f"v{offset}", op, 0, offset))
        folded[key] = None if op == "d" else f"v{offset}"
    table = SplitTable(spark, str(tmp_path_factory.mktemp("fold")), "k", split_bytes=1500, most_files=2)
    order = list(batches)
    random.Random(len(log)).shuffle(order)  # late batches hold older changes
    for cut in order + order[:1]:  # and one batch comes twice
        changes = spark.createDataFrame(batches[cut], ROW)
        table.merge(changes, newest_by=["pipeline_ts", "kafka_offset"])
    found = {r.k: r.v for r in live_rows(table.read()).collect()}
    assert found == {k: v for k, v in folded.items() if v is not None}


# Committed tables --------------------------------------------------------------------


def test_unfinished_commits_are_not_read(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.publish(spark.range(3))
    (tmp_path / "t" / "commit=0000000001").mkdir()
    assert table.read().count() == 3
    table.publish(spark.range(5))
    assert table.commits() == ["commit=0000000000", "commit=0000000002"]
    assert table.read().count() == 5
    assert table.drop_superseded(keep=0) == ["commit=0000000000", "commit=0000000001"]
    assert table.read().count() == 5


def test_a_transaction_is_applied_once(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.publish(spark.range(3), txn="q-1")
    assert not table.publish(spark.range(9), txn="q-1")
    assert table.read().count() == 3


# Joins -------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_key_is_split(spark, how):
    """A third of the rows on one key, and many rows without a key: the rows are those of a map,
    and adaptive execution cuts the partitions that the hot ones fall into."""
    many = spark.range(60_000).select(
        F.col("id").alias("row"),
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 50 END").alias("key"),
    )
    unique = spark.range(5, 40).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        joined = join_unique(many.repartition(8), unique, "key", how)
        found = {(r.row, r.twice) for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    keys = {i: 7 if i % 3 == 0 else None if i % 10 == 1 else i % 50 for i in range(60_000)}
    expected = {(i, 2 * k if k is not None and 5 <= k < 40 else None) for i, k in keys.items()}
    assert found == (expected if how == "left" else {e for e in expected if e[1] is not None})
    assert "isSkew=true" in plan or "skewed" in plan


# Vectors -----------------------------------------------------------------------------


def brute_force(corpus, queries, k):
    best = set()
    for q, qv in queries:
        qv = np.array(qv) / (np.linalg.norm(qv) + 1e-10)
        scored = [
            (round(float(np.array(v) @ qv / (np.linalg.norm(v) + 1e-10)), 12), n) for n, v in corpus
        ]
        best |= {(q, n, s) for s, n in sorted(scored, reverse=True)[:k]}
    return best


@pytest.mark.parametrize("corpus_bytes,query_bytes", [(10**6, 10**6), (10**6, 200), (900, 150)])
def test_topk_equals_brute_force(spark, corpus_bytes, query_bytes):
    """Copies, a zero vector, and grids of several cells."""
    rng = np.random.default_rng(3)
    corpus = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)]
    corpus += [(100 + i, corpus[5][1]) for i in range(5)] + [(200, [0.0] * 6)]
    queries = [(i, corpus[i][1]) for i in (5, 6, 7, 8, 9, 10)] + [(99, [0.0] * 6)]
    corpus_df = spark.createDataFrame(corpus, "note_id INT, embedding ARRAY<DOUBLE>").repartition(5)
    queries_df = spark.createDataFrame(queries, "query_id STRING, embedding ARRAY<DOUBLE>")
    found = cosine_topk(corpus_df, queries_df, k=4, corpus_bytes=corpus_bytes, query_bytes=query_bytes).collect()
    expected = brute_force(corpus, [(str(q), v) for q, v in queries], 4)
    assert {(r.query_id, r.note_id) for r in found} == {(q, n) for q, n, _ in expected}
    scores = {(q, n): s for q, n, s in expected}
    assert all(abs(r.score - scores[r.query_id, r.note_id]) < 1e-9 for r in found)


def test_topk_of_few_or_no_vectors(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "note_id INT, embedding ARRAY<FLOAT>")
    one = spark.createDataFrame([(1, [0.6, 0.8])], "query_id INT, embedding ARRAY<FLOAT>")
    assert [(r.note_id, round(r.score, 3)) for r in cosine_topk(corpus, one).collect()] == [(1, 0.6)]
    assert cosine_topk(corpus, one.limit(0)).count() == 0
    longer = spark.createDataFrame([(1, [0.6, 0.8, 0.0])], "query_id INT, embedding ARRAY<FLOAT>")
    assert cosine_topk(corpus, longer).count() == 0


def test_vectors_that_cannot_be_compared(spark):
    """The first query is odd, and so are some of the corpus; every good query keeps its k answers."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    good = [(i, [float(x) for x in rng.normal(size=2)]) for i in range(10)]
    bad = [(100, [None, 1.0]), (101, [nan, 1.0]), (102, [1.0, nan]), (103, [inf, 0.0]), (104, []), (105, None)]
    other = [(200 + i, [float(i), 1.0, 0.0]) for i in range(4)]
    corpus = spark.createDataFrame(bad + good + other, "note_id INT, embedding ARRAY<DOUBLE>")
    queries = spark.createDataFrame([(9, other[1][1])] + bad + [(1, good[0][1]), (2, good[5][1])], "query_id INT, embedding ARRAY<DOUBLE>")
    found = cosine_topk(corpus, queries, k=3).collect()
    expected = brute_force(good, [(1, good[0][1]), (2, good[5][1])], 3) | brute_force(other, [(9, other[1][1])], 3)
    assert {(r.query_id, r.note_id) for r in found} == {(q, n) for q, n, _ in expected}
    assert {(r.length, r.row_count) for r in left_out(corpus).collect()} >= {(2, 4), (0, 1)}


def test_scores_of_many_queries_take_bounded_memory():
    r = np.random.default_rng(5)
    asked, vectors, ids = unit(r.normal(size=(20_001, 4))), r.normal(size=(3_000, 4)), np.arange(3_000)
    tracemalloc.start()
    query, score, key = _top_of_cell(asked, ids, vectors, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All scores of a slice would be 328 MB.
    assert peak < 100 << 20
    assert (np.bincount(query, minlength=20_001) == 3).all()
    for at in (0, 511, 512, 20_000):
        whole = np.round(unit(vectors) @ asked[at], RANK_DIGITS)
        assert set(key[query == at]) == set(np.argsort(whole)[-3:])
    assert all(len(part) == 0 for part in _top_of_cell(asked[:0], ids, vectors, 3))


def test_few_pairs_are_scored_in_doubles(monkeypatch):
    """Scores that only doubles tell apart are ranked rightly, and most pairs are only multiplied as floats."""
    r = np.random.default_rng(6)
    base = r.normal(size=(6_000, 16))
    vectors = np.concatenate([base, base[:50] + r.normal(size=(50, 16)) * 1e-9, np.repeat(base[:3], 40, axis=0)])
    asked, ids = unit(base[:300]), r.permutation(len(vectors))
    gathered = []
    units = Held.units
    monkeypatch.setattr(Held, "units", lambda held, at: gathered.append(len(held.ids[at])) or units(held, at))
    query, score, key = _top_of_cell(asked, ids, vectors, 4)
    for at in range(300):
        whole = np.round(unit(vectors) @ asked[at], RANK_DIGITS)
        order = np.lexsort((ids, whole))[::-1][:4]
        assert key[query == at].tolist() == ids[order].tolist()
        assert np.abs(score[query == at] - whole[order]).max() < 1e-11
    assert sum(gathered) < 0.05 * len(asked) * len(vectors)


def test_scores_below_a_limit_are_not_kept():
    r = np.random.default_rng(8)
    vectors, asked = r.normal(size=(500, 8)).astype(np.float32), unit(r.normal(size=(20, 8)))
    whole = np.round(asked @ unit(vectors).T, RANK_DIGITS)
    limits = np.sort(whole, axis=1)[:, -2]
    met = Asked(asked, 3, limits)
    met.meet(Held(np.arange(500), vectors), 0, 500)
    query, score, key = met.best()
    assert sorted(zip(query, key)) == sorted(zip(*np.nonzero(whole >= limits[:, None])))


def test_a_row_without_an_id_can_be_found(spark):
    corpus = spark.createDataFrame([(None, [1.0, 0.0]), (2, [0.0, 1.0])], "note_id INT, embedding ARRAY<FLOAT>")
    one = spark.createDataFrame([(1, [0.8, 0.6])], "query_id INT, embedding ARRAY<FLOAT>")
    assert {(r.note_id, round(r.score, 3)) for r in cosine_topk(corpus, one).collect()} == {(None, 0.8), (2, 0.6)}
