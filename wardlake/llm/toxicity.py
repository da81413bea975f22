"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-cased words of a text and their first four and five bytes, as 64-bit hashes; a
text has a term or not. The machine adds a weight per term and, for each pair of terms present, the
product of their factors: it can tell an insult beside a group from either alone.

It is fitted on at most ``MOST_LABELLED`` labelled rows, those with the least hash of their id.
Terms are counted over these in Spark; those that labels favour by more than chance enter the machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.base import fold, rows_where, texts
from wardlake.llm.encoding import slices
from wardlake.llm.hashing import ALPHANUMERIC, Words, as_lists, column_bytes, mixed

#: Bounds of the fit: labelled rows, terms and factors per term.
MOST_LABELLED = 16_000
MOST_TERMS = 4_096
FACTORS = 6
LEAST_Z = 2.2
BATCH = 1_024
LEAST_EPOCHS = 12
LEAST_STEPS = 300
_U = np.uint64
FILTER_BITS = 20


def terms_of(column: pa.Array, among: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct terms of every text, or only those in a sorted array."""
    words = Words(*column_bytes(column), ALPHANUMERIC)
    kinds = [words.hashes(), *(mixed(words.hashes(most), most) for most in (4, 5))]
    rows = np.repeat(np.arange(len(column)), np.diff(words.first))
    if among is not None:
        # Most terms are none of these: a table of their leading bits leaves few to look up.
        table = np.zeros(1 << FILTER_BITS, bool)
        table[among >> _U(64 - FILTER_BITS)] = True
        picked = []
        for hashes in kinds:
            at = np.flatnonzero(table[hashes >> _U(64 - FILTER_BITS)])
            place = np.searchsorted(among, hashes[at])
            hit = among[np.minimum(place, len(among) - 1)] == hashes[at] if len(among) else np.zeros(0, bool)
            picked.append((rows[at][hit], hashes[at][hit]))
        all_rows, all_terms = (np.concatenate(x) for x in zip(*picked, strict=True))
        order = np.argsort(all_rows, kind="stable")
        all_rows, all_terms = all_rows[order], all_terms[order]
        edges = np.searchsorted(all_rows, np.arange(len(column) + 1))
        return [np.unique(all_terms[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    pairs = zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)
    return [np.unique(np.concatenate([k[a:b] for k in kinds])) for a, b in pairs]


@dataclass
class Machine:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, flat: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
        """Log odds of ``size`` texts whose terms, as places in ``terms``, are ``flat`` in ``rows``."""
        linear = np.bincount(rows, self.weights[flat], size)
        pairs = np.zeros(size)
        for f in self.factors.T:
            v = f[flat]
            pairs += np.bincount(rows, v, size) ** 2 - np.bincount(rows, v * v, size)
        return self.bias + linear + 0.5 * pairs

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        flat = np.searchsorted(self.terms, np.concatenate(found)) if found else np.zeros(0, np.int64)
        rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
        return 1 / (1 + np.exp(-np.clip(self.margin(flat, rows, len(found)), -30, 30)))


def fit(terms: np.ndarray, found: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Logistic loss with a small penalty, by Adam on shuffled batches."""
    rng = np.random.default_rng(7)
    size, n = len(terms), len(labels)
    rate = (labels.sum() + 1) / (n + 2)
    machine = Machine(terms, float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)))
    if not n:
        return machine
    places = [np.searchsorted(terms, f) for f in found]
    moments = [np.zeros((2, size)), np.zeros((2, size, FACTORS)), np.zeros(2)]
    epochs = max(LEAST_EPOCHS, -(-LEAST_STEPS // -(-n // BATCH)))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            some = order[at : at + BATCH]
            step += 1
            flat = np.concatenate([places[i] for i in some])
            rows = np.repeat(np.arange(len(some)), [len(places[i]) for i in some])
            margin = machine.margin(flat, rows, len(some))
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some)
            by_term = error[rows]
            weights = np.bincount(flat, by_term, size) + 1e-5 * machine.weights
            factors = 1e-4 * machine.factors
            for f in range(FACTORS):
                own = machine.factors[flat, f]
                factors[:, f] += np.bincount(flat, by_term * (np.bincount(rows, own, len(some))[rows] - own), size)
            values = machine.weights, machine.factors, machine.bias
            for i, (value, slope) in enumerate(zip(values, (weights, factors, error.sum()), strict=True)):
                m, v = 0.9 * moments[i][0] + 0.1 * slope, 0.999 * moments[i][1] + 0.001 * slope**2
                moments[i] = np.stack([m, v])
                moved = value - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                if i == 0:
                    machine.weights = moved
                elif i == 1:
                    machine.factors = moved
                else:
                    machine.bias = float(moved)
    return machine


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Machine:
    """The machine of labelled documents whose id is in the learning folds."""
    sample = F.broadcast(
        labels.where((fold(5) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(most)
    )
    labelled = texts(docs).join(sample, "doc_id")

    def run(among: np.ndarray | None):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    lists = as_lists(terms_of(batch.column("text"), among))
                    yield pa.RecordBatch.from_arrays([batch.column("toxic"), lists], ["toxic", "terms"])

        return labelled.select("text", "toxic").mapInArrow(rows, "toxic int, terms array<long>")

    totals = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = (totals[1] + 1) / (totals[0] + 2)
    z = (F.col("toxic") - rate * F.col("n")) / F.sqrt(rate * (1 - rate) * F.col("n") + 2)
    chosen = (
        run(None)
        .select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
        .where(F.abs(z) >= LEAST_Z)
        .orderBy(F.abs(z).desc(), "term")
        .limit(MOST_TERMS)
    )
    terms = np.sort(np.array([r.term for r in chosen.select("term").collect()], np.int64).view(_U))
    # As Arrow: rows as Python numbers would take several times the memory on the driver.
    table = run(terms).toArrow()
    found = [np.asarray(f.values).view(_U) for f in table.column("terms")]
    return fit(terms, found, table.column("toxic").to_numpy().astype(float))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5) of every row's whole text.

    Null and empty texts have no terms and get the score of the bias alone, as do all texts if no
    label or no telling term was found. Repeated rows give repeated rows, a null doc_id stays
    null, no rows give none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                scores = machine.scores(terms_of(batch.column("text"), machine.terms))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def calm(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs`` whose whole text scores below 0.5; ids are not looked at, and no rows give none."""

    def decide(batch: pa.RecordBatch) -> np.ndarray:
        return machine.scores(terms_of(batch.column("text"), machine.terms)) < 0.5

    return rows_where(docs, decide)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; see ``train`` and ``scored``."""
    rows = scored(docs, train(docs, labels))
    return rows.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")
