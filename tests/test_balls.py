"""Search by cells against the search of every pair of a query and a vector."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.operators import balls
from wardlake.operators.balls import BallIndex
from wardlake.operators.vectors import cosine_topk

CORPUS, ASKED = "note_id long, embedding array<float>, other string", "query_id string, embedding array<float>"


def clustered(rows: int, dims: int, groups: int, seed: int = 3) -> list[list[float]]:
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dims)) * 4
    return (centres[r.integers(0, groups, rows)] + r.normal(size=(rows, dims)) * 0.15).astype(np.float32).tolist()


def corpus_rows():
    near = clustered(500, 8, 6)
    odd = [None, [], [0.0] * 8, [0.0] * 8, [1e-7] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] * 8]
    other = clustered(40, 3, 2) + [[1.0, 0.0, 0.0]] * 9
    hot = [near[0]] * 260 + [[x * 2 for x in near[0]]] * 5
    return [(n, v, "x") for n, v in enumerate(near + odd + other + hot)] + [(None, near[1], "x")]


def asked_rows():
    near = clustered(500, 8, 6)[:40] + clustered(10, 8, 6, seed=9) + [[-x for x in near] for near in clustered(500, 8, 6)[:5]]
    odd = [None, [], [0.0] * 8, [1e-7] * 8, [float("nan")] * 8, [1.0] * 5]
    return [(f"q{n}", v) for n, v in enumerate(near + odd + clustered(10, 3, 2) + [[1.0, 0.0, 0.0]])] + [(None, near[0])]


def collected(hits):
    return sorted((r.query_id, r.note_id, round(r.score, 9)) for r in hits.collect())


@pytest.mark.parametrize("k, part_bytes, pass_bytes", [(3, 128 << 20, 1 << 30), (1, 2_000, 500), (7, 9_000, 2_000)])
def test_rows_equal_the_full_search(spark, tmp_path, monkeypatch, k, part_bytes, pass_bytes):
    monkeypatch.setattr(balls, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(balls, "QUERIES", 7)
    corpus, asked = spark.createDataFrame(corpus_rows(), CORPUS), spark.createDataFrame(asked_rows(), ASKED)
    index = BallIndex(spark, str(tmp_path / "index"))
    index.build(corpus, part_bytes)
    found = index.search(asked, str(tmp_path / "asked"), k, part_bytes=part_bytes, query_bytes=1_500)
    expected = cosine_topk(corpus.where("note_id IS NOT NULL"), asked.where("query_id IS NOT NULL"), k)
    assert collected(found.hits) == collected(expected)
    assert found.visits.groupBy("query_id", "length", "cell").count().where("count > 1").count() == 0


def test_cells_cover_the_corpus_and_bound_their_angles(spark, tmp_path):
    corpus = spark.createDataFrame(corpus_rows(), CORPUS)
    index = BallIndex(spark, str(tmp_path / "index"))
    index.build(corpus)
    cells = {(r.length, r.cell): r for r in index.cells().collect()}
    members = index.members().collect()
    assert sum(c.row_count for c in cells.values()) == len(members) == len({m.id for m in members}) == 500 + 3 + 49 + 265
    for m in members:
        c = cells[m.length, m.cell]
        if m.cell == balls.NO_ANGLE:
            assert c.pivot is None and np.linalg.norm(m.vector) < balls.LEAST_NORM
        else:
            angle = np.arccos(np.clip(np.dot(m.vector, c.pivot) / np.linalg.norm(m.vector) / np.linalg.norm(c.pivot), -1, 1))
            assert c.least - 1e-6 <= angle <= c.greatest + 1e-6


def test_most_cells_of_grouped_vectors_stay_unread(spark, tmp_path):
    corpus = spark.createDataFrame([(n, v, "") for n, v in enumerate(clustered(2_000, 16, 40))], CORPUS)
    asked = corpus.where("note_id % 20 = 0").select(F.col("note_id").cast("string").alias("query_id"), "embedding")
    index = BallIndex(spark, str(tmp_path / "index"))
    index.build(corpus)
    found = index.search(asked, str(tmp_path / "asked"))
    assert collected(found.hits) == collected(cosine_topk(corpus, asked))
    scored = found.visits.join(index.cells(), ["length", "cell"]).agg(F.sum("row_count")).first()[0]
    assert scored < 0.2 * 2_000 * asked.count()


def test_no_rows(spark, tmp_path):
    none, one = spark.createDataFrame([], CORPUS), spark.createDataFrame([("a", [1.0, 2.0])], ASKED)
    index = BallIndex(spark, str(tmp_path / "none"))
    index.build(none)
    assert index.search(one, str(tmp_path / "a")).hits.count() == 0
    full = BallIndex(spark, str(tmp_path / "full"))
    full.build(spark.createDataFrame([(5, [1.0, 2.0], "")], CORPUS))
    assert full.search(one.limit(0), str(tmp_path / "b")).hits.count() == 0
    assert collected(full.search(one, str(tmp_path / "c")).hits) == [("a", 5, 1.0)]


def test_queries_of_a_part_are_bounded_by_rows(spark):
    rows = spark.createDataFrame([(1_000_000, 2), (10, 2), (1, 4_000_000)], "n long, length int")
    parts = [r[0] for r in rows.select(balls._query_parts("n", 32 << 20)).collect()]
    # Narrow queries: 16 MB in all, but each may go to all cells.
    assert parts == [-(-1_000_000 // balls.QUERY_ROWS), 1, 1]


def test_a_query_goes_to_a_region_once(spark, tmp_path):
    """Vectors without structure: nearly all cells are visited, in as many rows as there are regions."""
    r = np.random.default_rng(11)
    corpus = spark.createDataFrame([(n, v, "") for n, v in enumerate(r.normal(size=(900, 12)).tolist())], CORPUS)
    asked = corpus.where("note_id % 9 = 0").select(F.col("note_id").cast("string").alias("query_id"), "embedding")
    index = BallIndex(spark, str(tmp_path / "index"))
    index.build(corpus)
    part_bytes = 900 * 12 * 8 // 4
    found = index.search(asked, str(tmp_path / "asked"), part_bytes=part_bytes)
    assert collected(found.hits) == collected(cosine_topk(corpus, asked))
    regions = index._regions(part_bytes).select("region").distinct().count()
    moved = spark.read.parquet(str(tmp_path / "asked" / "rest")).count()
    assert found.visits.count() > 10 * 100 and 4 <= regions <= 5 and moved <= regions * 100
    assert found.visits.groupBy("query_id", "length", "cell").count().where("count > 1").count() == 0
