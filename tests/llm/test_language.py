import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardlake.llm import language as lang
from wardlake.llm.queries import op3_language_id


def test_slopes_against_differences():
    rng = np.random.default_rng(4)
    network = lang.Network.new(["a", "b", "c"])
    data, inside = lang.windows_of([rng.integers(1, 255, n).astype(np.uint8).tobytes() for n in (9, 128, 300)])
    data, inside, labels = data[:, :12], inside[:, :12], np.array([0, 2, 1])
    for name in ("table", "recur", "candidate", "out", "bias"):
        setattr(network, name, getattr(network, name).astype(float))

    def loss():
        p = network.probabilities(network.states(data))
        return -(np.log(p[:, labels, np.arange(3)]) * inside.T).sum() / inside.sum()

    slopes = network.slopes(data, inside, labels)
    for weight, slope in zip(network.weights, slopes, strict=True):
        for at in np.argsort(-np.abs(slope).ravel())[:6]:
            before = weight.flat[at]
            weight.flat[at] = before + 1e-2
            high = loss()
            weight.flat[at] = before - 1e-2
            low = loss()
            weight.flat[at] = before
            assert np.isclose((high - low) / 2e-2, slope.flat[at], rtol=2e-2, atol=1e-5)


def test_pooling_covers_whole_texts_byte_by_byte():
    network = lang.Network.new(["a", "b"])
    texts = ["x" * 300, "", "héllo", "wörd " * 90]
    found = lang.pooled(network, pa.array(["skip"] + texts, pa.string()).slice(1))
    for text, mean in zip(texts, found, strict=True):
        raw = text.encode()
        total = np.zeros(2)
        for at in range(0, len(raw), lang.WIDTH):
            data, inside = lang.windows_of([raw[at : at + lang.WIDTH]])
            total += (network.probabilities(network.states(data))[:, :, 0] * inside.T).sum(0)
        assert np.allclose(mean, total / max(1, len(raw)), atol=1e-5)


def test_odd_rows(frame):
    rows = [(i, "hello there my friend " * 5 if i % 2 else "guten tag lieber freund " * 5, "en" if i % 2 else "de", "q") for i in range(60)]
    odd = [(100, None, "en", None), (101, "", "de", None), (102, "12 !!", "de", None), (None, "hello my friend", None, None),
           (103, "guten tag " * 9000, None, None), (1, rows[1][1], "en", None)]
    docs = frame(rows + odd, "doc_id int, text string, lang string, score string")
    found = lang.language_id(docs).collect()
    assert len(found) == 66 and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.lang_pred for r in found}
    assert all(by_id[i] == ("en" if i % 2 else "de") for i in range(60))
    assert [by_id[i] for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "en", "de"]
    assert {r.lang_pred for r in lang.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert lang.language_id(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = op3_language_id(spark, folder).where("held_out").join(truth, "doc_id")
    assert rows.where("lang != lang_pred").count() <= 0.01 * rows.count()


def plain_states(network, data):
    """One step after the other, with new arrays for each."""
    units, (size, width) = lang.UNITS, data.shape
    h, out = np.zeros((2, units, size), np.float32), np.empty((width, 2, units, size), np.float32)
    for t in range(width):
        read = (data[:, t], data[:, width - 1 - t])
        given = np.stack([network.table[d][:, read[d]] for d in (0, 1)])
        gates = 0.5 + 0.5 * np.tanh(0.5 * (given[:, : 2 * units] + network.recur @ h))
        c = np.tanh(given[:, 2 * units :] + network.candidate @ (gates[:, units:] * h))
        h = c + gates[:, :units] * (h - c)
        out[t, 0], out[width - 1 - t, 1] = h[0], h[1]
    return out


def test_states_are_those_of_the_plain_recurrence_in_less_time():
    network = lang.Network.new(["a", "b"])
    data = np.random.default_rng(5).integers(0, 256, (2048, 64)).astype(np.uint8)
    keep: list = []
    assert np.array_equal(network.states(data), plain_states(network, data))
    assert np.array_equal(network.states(data, keep), plain_states(network, data)) and len(keep) == 64

    def least(run):
        took = []
        for _ in range(4):
            start = time.process_time()
            run(network, data)
            took.append(time.process_time() - start)
        return min(took)

    assert least(lang.Network.states) < 0.9 * least(plain_states)
