"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WIDTH`` bytes. One network reads each window forwards, another
backwards; from both states at a byte come the probabilities of its language. A document's
probabilities are the mean over all its bytes.

The network is fitted by backpropagation through time on at most ``MOST_WINDOWS`` windows per
language, one from each of the documents with the least hash of their id, at a place set by that hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.base import fold, rows_where, texts
from wardlake.llm.encoding import slices
from wardlake.llm.hashing import column_bytes

WIDTH = 128
UNITS = 12
#: Bound of the fit: windows of each language.
MOST_WINDOWS = 768
SALTS = 16
EPOCHS = 24
BATCH = 96
BLOCK = 4096
UNDETERMINED = "und"


@dataclass
class Network:
    """Arrays have a first axis for the two directions, and features before examples.

    ``table``: what a byte adds to update, reset and candidate, biases included; ``recur`` and
    ``candidate``: what the state adds to the first two and to the last; ``out``: both states to languages.
    """

    languages: list[str]
    table: np.ndarray
    recur: np.ndarray
    candidate: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str]) -> Network:
        rng = np.random.default_rng(11)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(
            languages,
            normal(2, 3 * UNITS, 256, scale=0.3),
            normal(2, 2 * UNITS, UNITS, scale=UNITS**-0.5),
            normal(2, UNITS, UNITS, scale=UNITS**-0.5),
            normal(len(languages), 2 * UNITS, scale=0.3),
            np.zeros((len(languages), 1), np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.table, self.recur, self.candidate, self.out, self.bias]

    def states(self, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, direction, unit, example) for bytes (example, time). Arrays of a step are used again by the
        next, unless ``keep`` takes them."""
        size, width = data.shape
        kind = np.result_type(self.table, self.recur, self.candidate)
        h = np.zeros((2, UNITS, size), kind)
        states = np.empty((width, 2, UNITS, size), np.float32)
        both = np.stack([data.T, data.T[::-1]])
        # sigmoid(x) is 0.5 + 0.5 * tanh(0.5 * x): the inner half goes into the weights, which is exact.
        half = np.float32(0.5)
        table, recur = self.table.astype(kind), self.recur * half
        table[:, : 2 * UNITS] *= half
        given, gates, c, reset = (np.empty((2, n * UNITS, size), kind) for n in (3, 2, 1, 1))
        for t in range(width):
            if keep is not None:
                gates, c = np.empty_like(gates), np.empty_like(c)
            for d in (0, 1):
                np.take(table[d], both[d, t], axis=1, out=given[d], mode="clip")
            np.matmul(recur, h, out=gates)
            gates += given[:, : 2 * UNITS]
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            z, r = gates[:, :UNITS], gates[:, UNITS:]
            np.matmul(self.candidate, np.multiply(r, h, out=reset), out=c)
            c += given[:, 2 * UNITS :]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((both[:, t], h, gates, c))
            h = np.subtract(h, c, out=None if keep is not None else h)
            h *= z
            h += c
            states[t, 0], states[width - 1 - t, 1] = h[0], h[1]
        return states

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(time, language, example)"""
        width, _, _, size = states.shape
        logits = self.out @ states.reshape(width, 2 * UNITS, size) + self.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def slopes(self, data: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Slopes of the mean loss per byte: ``inside`` (example, time) marks bytes of the text."""
        size, width = data.shape
        keep: list = []
        states = self.states(data, keep)
        error = self.probabilities(states)
        error[:, labels, np.arange(size)] -= 1
        error *= (inside.T / inside.sum())[:, None]
        flat = states.reshape(width, 2 * UNITS, size)
        d_out = np.einsum("tls,tus->lu", error, flat, optimize=True)
        d_bias = error.sum((0, 2))[:, None]
        d_states = (self.out.T @ error).reshape(width, 2, UNITS, size)
        d_table, d_recur, d_candidate = (np.zeros_like(w) for w in self.weights[:3])
        d_h = np.zeros((2, UNITS, size), np.float32)
        for t in range(width - 1, -1, -1):
            read, h, gates, c = keep[t]
            z, r = gates[:, :UNITS], gates[:, UNITS:]
            d_h = d_h + np.stack([d_states[t, 0], d_states[width - 1 - t, 1]])
            d_c = d_h * (1 - z) * (1 - c * c)
            through = self.candidate.transpose(0, 2, 1) @ d_c
            d_gates = np.concatenate([d_h * (h - c), through * h], 1) * gates * (1 - gates)
            d_candidate += d_c @ (r * h).transpose(0, 2, 1)
            d_recur += d_gates @ h.transpose(0, 2, 1)
            given = np.concatenate([d_gates, d_c], 1)
            for d in (0, 1):
                order = np.argsort(read[d], kind="stable")
                values, edges = np.unique(read[d][order], return_index=True)
                d_table[d][:, values] += np.add.reduceat(given[d][:, order], edges, axis=1)
            d_h = d_h * z + through * r + self.recur.transpose(0, 2, 1) @ d_gates
        return [d_table, d_recur, d_candidate, d_out, d_bias]


def fit(languages: list[str], data: np.ndarray, inside: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam on shuffled batches; every language weighs as its windows are many."""
    network, rng = Network.new(languages), np.random.default_rng(12)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network.weights]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            slopes = network.slopes(data[some], inside[some], labels[some])
            size = np.sqrt(sum(float((s * s).sum()) for s in slopes))
            for weight, slope, (m, v) in zip(network.weights, slopes, moments, strict=True):
                slope = slope * min(1.0, 1.0 / max(size, 1e-9))
                m += 0.1 * (slope - m)
                v += 0.002 * (slope * slope - v)
                rate = 0.02 * (1 - epoch / epochs) + 0.001
                weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.998**step)) + 1e-7)
    return network


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def windows_of(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, inside = np.zeros((len(rows), WIDTH), np.uint8), np.zeros((len(rows), WIDTH), np.float32)
    for i, raw in enumerate(rows):
        raw = raw[:WIDTH]
        data[i, : len(raw)] = np.frombuffer(raw, np.uint8)
        inside[i, : len(raw)] = 1
    return data, inside


def train(docs: DataFrame, most: int = MOST_WINDOWS) -> Network | None:
    """The network of documents in the learning folds that have a language and a letter; None
    where there are none."""
    chance = F.xxhash64("doc_id", F.lit("language"))
    place = F.pmod(chance, F.greatest(F.length("text") - WIDTH, F.lit(0)) + 1) + 1
    known = docs.where((fold(4) != 2) & F.col("lang").isNotNull() & has_letter(F.col("text").cast("string"))).select(
        F.col("lang").cast("string").alias("lang"), chance.alias("chance"), F.col("text").substr(place.cast("int"), F.lit(WIDTH)).alias("part")
    )
    # Salted, so that a language with most of the rows is ranked by many tasks.
    rank = F.row_number().over(Window.partitionBy("lang", F.pmod("chance", F.lit(SALTS))).orderBy("chance", "part"))
    rows = known.withColumn("rank", rank).where(F.col("rank") <= most // SALTS).select("lang", "part").collect()
    if not rows:
        return None
    rows.sort()
    languages = sorted({r.lang for r in rows})
    data, inside = windows_of([r.part.encode() for r in rows])
    return fit(languages, data, inside, np.array([languages.index(r.lang) for r in rows]))


def pooled(network: Network, column: pa.Array) -> np.ndarray:
    """Mean probabilities (text, language) over the bytes of each text; 0 for empty texts."""
    data, offsets = column_bytes(column)
    sizes = np.diff(offsets)
    counts = -(-sizes // WIDTH)
    owner = np.repeat(np.arange(len(sizes)), counts)
    ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][owner] + ordinal * WIDTH
    lengths = np.minimum(WIDTH, sizes[owner] - ordinal * WIDTH)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    sums = np.zeros((len(sizes), len(network.languages)))
    for at in range(0, len(owner), BLOCK):
        some = slice(at, at + BLOCK)
        inside = np.arange(WIDTH) < lengths[some, None]
        block = np.where(inside, padded[starts[some, None] + np.arange(WIDTH)], 0).astype(np.uint8)
        probabilities = network.probabilities(network.states(block))
        per_window = np.einsum("tls,st->sl", probabilities, inside.astype(np.float32), optimize=True)
        np.add.at(sums, owner[some], per_window)
    return sums / np.maximum(sizes, 1)[:, None]


def decided(network: Network | None, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of every text of a batch with ``text`` and ``lettered``."""
    lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
    if network is None:
        return np.full(len(lettered), UNDETERMINED, object), np.zeros(len(lettered))
    means = pooled(network, batch.column("text"))
    best = means.argmax(1)
    names = np.where(lettered, np.array(network.languages, object)[best], UNDETERMINED)
    return names, np.where(lettered, means[np.arange(len(best)), best].clip(0, 1), 0.0)


def of_a_language(docs: DataFrame, network: Network | None, least: float) -> DataFrame:
    """The rows of ``docs`` whose whole text has a letter and a language with at least ``least`` of its bytes. Null
    and empty texts have none; ids are not looked at; no rows give none."""

    def decide(batch: pa.RecordBatch) -> np.ndarray:
        names, scores = decided(network, batch)
        return (names != UNDETERMINED) & (scores >= least)

    return rows_where(docs, decide, lettered=has_letter(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def identified(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred, score of every row's whole text.

    A text that is null or has no letter is "und" with score 0, as are all if no language was learned.
    Repeated rows give repeated rows, a null doc_id stays null, no rows give none; other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                names, scores = decided(network, batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = texts(docs, has_letter(text).alias("lettered"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; see ``train`` and ``identified``."""
    return identified(docs, train(docs)).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
