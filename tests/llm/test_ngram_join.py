import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlake.llm import ngram_join as nj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x] if j < i}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(low.get(root(i), doc_id), doc_id)
    return sorted(
        ((d, len(s), (low.get(root(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def result(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in nj.near_duplicates(docs).collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB \t\n\x1c\xa0é"), max_size=40), max_size=6))
def test_sets_have_the_sizes_and_overlaps_of_word_shingles(rows):
    column = pa.array(["before"] + rows, pa.string()).slice(1)
    found = [set(s.tolist()) for s in nj.shingle_sets(column)]
    plain = [shingles(t) for t in rows]
    assert [len(s) for s in found] == [len(s) for s in plain]
    for a, x in zip(found, plain, strict=True):
        for b, y in zip(found, plain, strict=True):
            assert len(a & b) == len(x & y)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    missed = 0
    for size in [*range(1, 40), 50, 64, 80, 100, 200, 333, 700, 2000, 20000]:
        for _ in range(12):
            a = rng.integers(0, 2**63, size).astype(np.uint64)
            most = 2 * size // 7
            drop = int(rng.integers(0, most + 1))
            keep = rng.permutation(a)[drop // 2 :]
            b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, drop - drop // 2).astype(np.uint64)]))
            a = np.unique(a)
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 75 * (len(a) + len(b) - shared):
                one, safe_a = nj.signatures(a)
                two, safe_b = nj.signatures(b)
                assert safe_a and safe_b
                missed += not len(np.intersect1d(one, two))
    assert missed == 0


def test_bands_hold_all_linked_sizes():
    ends = nj.band_ends()
    for size in range(1, 3000):
        own, far = (int(np.searchsorted(ends, n)) for n in (size, 4 * size // 3))
        assert far - own <= 1


WORDS = [f"w{i}" for i in range(400)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[int(rng.integers(len(words)))] = f"new{int(rng.integers(10**6))}"
    return " ".join(words)


def test_near_copies_against_brute_force(spark, frame):
    rng = np.random.default_rng(3)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (7, "a b c d e"),
            (None, "only null"), (None, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"), (9, "b a c d e")]
    for start in range(100, 600, 60):
        base = [WORDS[int(i)] for i in rng.integers(0, 400, int(rng.integers(8, 300)))]
        for step in range(12):
            text = edited(rng, base, int(rng.integers(0, max(2, len(base) // 20))))
            rows.append((start + 11 - step, text))
            if step % 3 == 0:
                base = text.split()
    passage = " ".join(WORDS[:60])
    rows += [(1000 + i, f"{passage} tail{i} more{i} words{i} at{i} end{i}") for i in range(40)]
    rows += [(2000 + i, " ".join([*WORDS[i : i + 30], "x"] * 2)) for i in range(30)]
    docs = frame([(d, t, "clash") for d, t in rows], "doc_id long, text string, key string")
    assert result(docs) == brute_force(rows)


def test_no_rows(frame):
    assert nj.near_duplicates(frame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_brute_force(spark, sf):
    from wardlake.llm.queries import op1_ngram_jaccard

    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = op1_ngram_jaccard(spark, f"/root/testdata/{sf}")
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str) == brute_force(rows)


def linked_classes(rows):
    """Links of every row, counted over all pairs of different shingle sets."""
    classes = {s for s in (shingles(t) for _, t in rows) if s}
    links = {s: sum(100 * len(s & x) >= 75 * len(s | x) for x in classes if x != s) for s in classes}
    return sorted(((d, links.get(shingles(t), 0)) for d, t in rows), key=str)


@pytest.mark.parametrize(("cell", "most"), [(512, 1 << 20), (7, 300)])
def test_links_against_brute_force(frame, monkeypatch, cell, most):
    monkeypatch.setattr(nj, "CELL_SETS", cell)
    monkeypatch.setattr(nj, "CELL_SHINGLES", most)
    rng = np.random.default_rng(8)
    rows, base = [(1, None), (2, "alone in the table with no one near")], WORDS[:120]
    rows += [(10 + i, " ".join([*base, f"end{i}"])) for i in range(3)]
    for group in range(3):
        base = [WORDS[int(i)] for i in rng.integers(0, 400, 200)]
        rows += [(100 * (group + 1) + i, edited(rng, base[: 200 - 3 * i], int(rng.integers(0, 5)))) for i in range(25)]
    rows += [(1000 + i, " ".join(WORDS[i : i + 60])) for i in range(30)]
    rows += [(2000, rows[4][1]), (None, rows[9][1])]
    expected = linked_classes(rows)
    assert [n for d, n in expected if d in (10, 11, 12)] == [2, 2, 2] and max(n for _, n in expected) > 8
    docs = frame(rows, "doc_id long, text string")
    found = nj.near_duplicates(docs.repartition(5)).select("doc_id", "links").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected


def test_sets_that_share_many_groups_are_compared_once_each(spark, tmp_path):
    groups = {s: [1, 2, 3, 4] for s in range(9)} | {100 + i: [10, 11 + i] for i in range(20)}
    rows = [(s, len(m), c, c, (min(m), min(m))) for s, m in groups.items() for c in m]
    schema = "signature long, n long, cls long, component long, lead struct<component: long, cls: long>"
    dense, rest = nj.clusters_of(spark.createDataFrame(rows, schema), str(tmp_path))
    assert sorted(map(tuple, dense.collect())) == [(c, 1) for c in (1, 2, 3, 4)]
    assert {r.signature for r in rest.collect()} == {100 + i for i in range(20)}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=12))
def test_a_forest_connects_what_the_links_do(pairs):
    link = np.zeros((10, 10), bool)
    for a, b in pairs:
        link[a, b] = link[b, a] = a != b
    found = nj.forest(pa.array(range(100, 110)), link).to_pylist()
    reach = {x: {x} for x in range(100, 110)}
    for e in found:
        whole = reach[e["a"]] | reach[e["b"]]
        for x in whole:
            reach[x] = whole
    power = np.linalg.matrix_power((link | np.eye(10, dtype=bool)).astype(np.float64), 10) > 0
    assert len(found) < 10
    assert all((100 + b in reach[100 + a]) == power[a, b] for a in range(10) for b in range(10))
