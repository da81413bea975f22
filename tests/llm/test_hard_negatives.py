import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, id string, score string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, k=5):
    kept = [
        (i, label, [math.floor(256 * float(x)) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, label, v in kept:
        if i % every == 0:
            raw = (label, 2, np.array(v, "<i2").tobytes())
            anchors[i] = min(anchors.get(i, (raw, label, v)), (raw, label, v))
    out = []
    for a, (_, label, v) in anchors.items():
        met = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in kept if i != a and len(w) == len(v)]
        for score, positive, _ in sorted(m for m in met if m[2] == label)[:k]:
            negatives = sorted(m for m in met if m[2] != label and 80 * -score <= 100 * -m[0] <= 100 * -score)[:k]
            out += [(a, positive, n, i, -score, -s) for n, (s, i, _) in enumerate(negatives, 1)]
    return sorted(out)


def mined(spark, rows, every, **options):
    frame = spark.createDataFrame([(*r, "c", "i", "s") for r in rows], SCHEMA)
    found = hn.hard_negatives(frame.repartition(3), F.col("id") % every == 0, **options)
    return sorted(tuple(r) for r in found.select(*COLUMNS).collect())


def some_rows(seed, n=400, values=lambda r: r.uniform(-1, 1)):
    r = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(values(r)) for _ in range(6)], r.choice([0, 0, 1, 2])) for i in range(n)]
    rows += [(None, rows[0][1], 1), (n + 1, None, 1), (n + 2, rows[1][1], None), (n + 3, [], 1), (10 * n, [], 0), (10 * n + 10, [], 1)]
    rows += [(n + 4, [1.0, None] + [0.0] * 4, 1), (n + 5, [math.nan] + [0.0] * 5, 1), (n + 6, [math.inf] + [0.0] * 5, 1)]
    rows += [(n + 7, [1.0, 2.0], 1), (20 * n, [1.0, 1.0], 1), (n + 8, [1.5, 0.5], 0)]
    return rows + [rows[3], rows[10], (20, rows[5][1], 2)]


@pytest.mark.parametrize("seed,values", [(1, lambda r: r.uniform(-1, 1)), (2, lambda r: r.choice([0.0, 0.5, 1.0]))])
def test_equals_brute_force(spark, monkeypatch, seed, values):
    monkeypatch.setattr(hn, "LEAST_CELL_BYTES", 512)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 8)
    rows = some_rows(seed, values=values)
    found = mined(spark, rows, 10)
    assert found == brute(rows, 10) and len(found) > 300


def test_all_rows_equal_and_no_rows(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(60)]
    assert mined(spark, rows, 20) == brute(rows, 20)
    assert mined(spark, [], 20) == []
    assert mined(spark, [(1, None, None)], 1) == []


def test_products_are_exact_whatever_their_size():
    r = np.random.default_rng(3)
    for most, length in ((5, 3), (1 << 14, 2500), (1 << 22, 300)):
        a, b = (r.integers(-most, most, (4, length)).astype(np.int32) for _ in range(2))
        exact = a.astype(object) @ b.astype(object).T
        primes = hn.moduli(length * most * most)
        assert (hn.products(a, b, primes) == exact).all()
        extreme = np.full((1, length), -most, np.int32)
        assert hn.products(extreme, extreme, primes)[0, 0] == length * most * most
        assert all((p // 2) ** 2 * hn.LONGEST < 1 << 24 for p in primes)


def test_scores_that_are_no_64_bit_integers_are_refused(spark):
    with pytest.raises(Exception, match="square norm"):
        mined(spark, [(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 1)], 1)
