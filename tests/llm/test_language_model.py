import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wardlake.llm import language_model as lm
from wardlake.llm.queries import op4_language_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def expected(rows):
    counts = Counter(t for d, text in rows if not held(d) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((doc_id, held(doc_id), len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def same(rows, found):
    found = sorted(found, key=lambda r: (str(r.doc_id), r.base_score))
    plain = sorted(expected(rows), key=lambda r: (str(r[0]), r[5]))
    assert [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in found] == [p[:5] for p in plain]
    assert np.allclose([r.base_score for r in found], [p[5] for p in plain], rtol=1e-9)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in found)


ROWS = [(i, f"the Cat {i % 7} sat on THE mat\tnumber {i}") for i in range(40)]
ODD = [(100, None), (101, ""), (None, "the cat"), (3, "other text\xa0here"), (3, "other text\xa0here"), (102, "word é " * 30_000)]


def test_counts_and_base_against_plain_python(frame, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 300)
    docs = frame([(d, t, "x") for d, t in ROWS + ODD], "doc_id int, text string, words string")
    same(ROWS + ODD, lm.scores(docs.repartition(3)).collect())
    assert lm.scores(docs.limit(0)).count() == 0
    only = [(d, t) for d, t in ROWS if held(d)]
    same(only, lm.scores(frame(only, "doc_id int, text string"), rounds=1).collect())


def test_probabilities_of_classes_sum_to_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(lm.FEATURES, lm.CLASSES)).astype(np.float32)
    rows = rng.integers(0, lm.FEATURES, (50, 4))
    logs = np.stack([lm.class_logs(weights, rows, np.full(50, k)) for k in range(1, lm.CLASSES)])
    assert np.allclose(np.exp(logs).sum(0), 1, atol=1e-5)
    assert not lm.class_odds(weights, rows)[:, 0].any()


def test_steps_follow_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    rows, kinds = rng.integers(0, 40, (300, 4)), rng.integers(1, 5, 300)
    weights = np.zeros((lm.FEATURES, lm.CLASSES), np.float32)

    def loss():
        return -lm.class_logs(weights, rows, kinds).mean()

    before, slopes = loss(), np.zeros_like(weights)
    for _ in range(30):
        lm.steps(weights, slopes, rows, kinds)
    assert loss() < 0.6 * before


def test_query_beats_the_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = op4_language_model(spark, folder)
    same(rows, found.collect())
    total = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert total[0] > 0.98 * total[1]


def test_tasks_without_a_feature_take_nothing_from_its_weights(frame):
    schema = "doc_id long, text string"
    own = frame([(i, "red apple pie " * 40) for i in range(20)], schema).coalesce(1)
    word = lm.Words(*lm.column_bytes(lm.pa.array(["red"]))).hashes()
    row = int(lm.mixed(word, 6)[0] % np.uint64(lm.HASHED))
    alone = lm.trained(lm.chunks(own), word, rounds=1)
    docs = own
    for part in range(1, 6):
        docs = docs.union(frame([(100 * part + i, f"blue stone{part} wall " * 40) for i in range(20)], schema).coalesce(1))
    among = lm.trained(lm.chunks(docs), word, rounds=1)
    assert np.abs(alone[row]).max() > 0.1 and np.allclose(among[row], alone[row], rtol=1e-3, atol=1e-6)


def test_size_of_the_model():
    assert (lm.CLASSES, lm.FREQUENT) == (64, 15) and lm.ROUNDS >= 2


def test_slopes_are_summed_by_feature_whether_it_has_few_tokens_or_many():
    rng = np.random.default_rng(3)
    rows = np.stack([rng.zipf(1.3, 2_048) % 5_000, rng.integers(5_000, 12_000, 2_048), np.arange(2_048) // 25 + 12_000], 1)
    error = rng.random((2_048, lm.CLASSES), dtype=np.float32)
    expected = np.zeros((lm.FEATURES, lm.CLASSES))
    for column in rows.T:
        np.add.at(expected, column, error)
    features, sums = lm.slope_sums(error, rows)
    found = np.zeros_like(expected)
    found[features] = sums
    assert len(set(features.tolist())) == len(features) and set(features.tolist()) == set(rows.ravel().tolist())
    assert np.bincount(rows.ravel()).max() > lm.MANY_TOKENS and np.allclose(found, expected, rtol=1e-4)
