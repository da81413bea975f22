from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wardlake.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, mass string, block string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], SCHEMA)


def brute_targets(sizes):
    """Targets by source, by sharing again until none is above."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, Fraction(3, 2) * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: Fraction(2 * sizes[s]) for s in above}


def many(n=900):
    words = lambda k: " \t".join(["w"] * k)
    rows = [(i, words(1 + i * 7 % 40), "big" if i % 3 == 0 else f"s{i % 8}") for i in range(n)]
    rows += [(n + i, words(300), "s\U0001f600") for i in range(4)] + [(n + 9, None, "s1"), (n + 10, "", "void"), (n + 11, " \n", "")]
    rows += [(None, words(3), None), (None, words(3), None), (5, words(9), None), (5, words(9), None), (5, words(8), None)]
    return rows + [(7, words(2), "s2")] * 40


def test_targets_and_copies(spark):
    rows = many()
    out = mixing.mix(docs_of(spark, rows), block=8).collect()
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in out) == sorted(
        (str(i), str(s), len((t or "").split())) for i, t, s in rows
    )
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    wanted = brute_targets(dict(sizes))
    for r in out:
        assert r.target == pytest.approx(float(wanted[r.source])) and r.source_size == sizes[r.source]
        ratio = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size <= 2 * r.size
        assert r.copies in (int(ratio + 1e-9), int(ratio + 1e-9) + 1) or not r.size
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = many(300)
    runs = [mixing.mix(docs_of(spark, rows).repartition(n)).collect() for n in (1, 5)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))


def test_no_rows_and_no_words(spark):
    assert mixing.mix(docs_of(spark, [])).collect() == []
    found = mixing.mix(docs_of(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in found} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_a_fold_settles_all_but_one_and_keeps_what_is_expected(spark):
    """Over many draws a document gets its mass on average, and a block never changes its sum."""
    masses = [(10.0, 4.0), (3.0, 1.5), (50.0, 20.0), (7.0, 6.0), (1.0, 0.5)]
    unit = ", ".join(
        f"named_struct('key', xxhash64(id, {i}), 'doc_id', {i}L, 'copy', 0L, 'size', {int(a)}L, 'mass', {x}D)"
        for i, (a, x) in enumerate(masses)
    )
    folded = spark.range(4000).select(mixing.fold(F.expr(f"array({unit})"), 0).alias("f")).collect()
    total, mean = sum(x for _, x in masses), defaultdict(float)
    for (f,) in folded:
        units = list(f.settled) + ([f.open] if f.open else [])
        assert len(units) == len(masses) and sum(u.mass for u in units) == pytest.approx(total)
        assert all(u.mass in (0, u.size) for u in f.settled) and (f.open is None or 0 < f.open.mass < f.open.size)
        for u in units:
            mean[u.doc_id] += u.mass / len(folded)
    for i, (a, x) in enumerate(masses):
        assert abs(mean[i] - x) < 4 * a / 2 / len(folded) ** 0.5


def test_texts_as_often_as_they_are_taken(spark):
    docs = docs_of(spark, [(i, "a b c", "s" if i % 2 else "t") for i in range(40)])
    mixed = mixing.mix(docs)
    copies = sum(r.copies for r in mixed.collect())
    assert mixing.mixed_texts(docs, mixed).count() == copies == 60
