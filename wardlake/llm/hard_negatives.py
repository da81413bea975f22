"""Hard negatives by exact integer products in a residue number system.

Components become integers, ``floor(scale * x)``. Their inner products are wanted exactly, but the fastest
products of matrices are those of 32-bit floats, which are exact only below 2**24. So the matrices are
multiplied once for each of several primes, with components reduced to residues around 0: a product of
``LONGEST`` such terms stays below 2**24. The Chinese remainder theorem puts the signed score together from
the residues; as many primes are taken as the largest possible score, the greatest square norm, needs.

All rows are dealt, by hashes of their places, to cells of bounded size. Each cell's task holds its rows and
lets the anchors, a stated part of all rows, pass by in batches. The first pass gives each anchor's best rows of its
own label (only those meet), of which windows over all cells choose the positives. In the second pass the
anchors bring their positives' scores, and a cell returns, for each of them, the best rows of other labels that lie in
its score window. No cell returns more than the number wanted, no pair of an anchor and a row becomes a row of a table otherwise,
and what is shuffled is narrow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.base import written
from wardlake.operators.dedupe import first_per_group
from wardlake.session import run_folder, ship_package

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Per cent of the positive's score from which a row is a hard negative; it ends at the positive's score.
LEAST_PERCENT = 80
#: Terms of a product whose sum of residues' products stays below 2**24, for primes below 256.
LONGEST = 1 << 10
#: Bytes of components in a cell, and the least for which more cells than cores are worth while.
CELL_BYTES = 128 << 20
LEAST_CELL_BYTES = 64 << 10
#: Rows of a cell and anchors that are multiplied at a time.
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 256
#: Square norms are below this, so that a score and 100 times it are 64-bit integers.
MOST_NORM = 1 << 55
PREPARED = "id long, label long, width int, components binary, norm long"


def primes_below(limit: int) -> Iterator[int]:
    for n in range(limit - 1, 2, -1):
        if all(n % d for d in range(2, math.isqrt(n) + 1)):
            yield n


def moduli(most: int) -> list[int]:
    """Primes whose product tells all whole numbers from ``-most`` to ``most`` apart."""
    chosen, product = [], 1
    for prime in primes_below(256):
        chosen.append(prime)
        product *= prime
        if product > 2 * most:
            return chosen
    raise ValueError("no primes left")


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Residues from -(prime - 1) / 2 to (prime - 1) / 2 as 32-bit floats."""
    half, wide = prime // 2, np.int32 if matrix.itemsize == 2 else np.int64
    return ((matrix.astype(wide) + half) % prime - half).astype(np.float32)


def products(left: np.ndarray, right: np.ndarray, primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, if the product of the primes is more than
    twice any of them."""
    total, known = None, 1
    for prime in primes:
        sums = np.zeros((len(left), len(right)), np.int64)
        for at in range(0, left.shape[1], LONGEST):
            part = residues(left[:, at : at + LONGEST], prime) @ residues(right[:, at : at + LONGEST], prime).T
            sums += part.astype(np.int64)
        if total is None:
            total = sums % prime
        else:
            # total + known * digit has the residues of all primes so far.
            total += known * ((sums - total) % prime * pow(known, -1, prime) % prime)
        known *= prime
    total[total > known // 2] -= known
    return total


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` first by descending score, then by ascending id."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def in_windows(scores: np.ndarray, ids: np.ndarray, tops: list[int], most: int, percent: int) -> np.ndarray:
    """Places of the ``most`` first of each window that ends at one of ``tops``."""
    order = np.lexsort((ids, -scores))
    falling = -scores[order]
    found = []
    for top in set(tops):
        first = np.searchsorted(falling, -top)
        near = order[first : first + most]
        found.append(near[100 * scores[near] >= percent * top])
    return np.unique(np.concatenate(found)) if found else order[:0]


Vectors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def by_length(batch: pa.RecordBatch | pa.Table) -> dict[int, Vectors]:
    """For each length of vectors: ids, labels, components in the width of the widest, and places in the batch."""
    ids, labels, widths = (np.asarray(batch.column(c)) for c in ("id", "label", "width"))
    raw = batch.column("components").to_pylist()
    lengths = np.array([len(r) for r in raw], np.int64) // widths
    found = {}
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        matrix = np.empty((len(at), length), f"<i{widths[at].max()}")
        for width in np.unique(widths[at]).tolist():
            these = np.flatnonzero(widths[at] == width)
            joined = b"".join([raw[i] for i in at[these].tolist()])
            matrix[these] = np.frombuffer(joined, f"<i{width}").reshape(len(these), length)
        found[length] = (ids[at], labels[at], matrix, at)
    return found


def of_cell(batches: list[pa.RecordBatch]) -> dict[int, Vectors]:
    """The rows of a cell, within a length by label and id."""
    found = by_length(pa.Table.from_batches(batches)) if batches else {}
    for length, columns in found.items():
        order = np.lexsort(columns[:2])
        found[length] = tuple(c[order] for c in columns)
    return found


def prepare(rows: DataFrame, id: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """id, label, and the integer components as little-endian integers of ``width`` bytes, with their square norm,
    of the rows that have an id, a label, and a vector of finite numbers."""
    chosen = rows.select(
        F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")
    ).where("id is not null and label is not null and v is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            ends = lists.offsets.to_numpy()
            flat = lists.values.slice(0, ends[-1]).to_numpy(zero_copy_only=False).astype(np.float64)  # unknown ones are NaN
            whole = np.floor(scale * flat)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            squares = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(whole), whole, 0.0) ** 2)])
            out: list[tuple] = []
            for n, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                if bad[b] > bad[a]:
                    continue
                part = whole[a:b]
                most = float(np.abs(part).max()) if b > a else 0.0
                norm = float(part @ part)
                if norm >= MOST_NORM:
                    raise ValueError("a square norm of 2**55 or more: scores would not be 64-bit integers")
                width = 2 if most < 1 << 15 else 4
                out.append((n, width, part.astype(f"<i{width}").tobytes(), int(norm)))
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at),
                    batch.column("label").take(at),
                    *(pa.array([o[i] for o in out], t) for i, t in ((1, pa.int32()), (2, pa.binary()), (3, pa.int64()))),
                ],
                ["id", "label", "width", "components", "norm"],
            )

    return chosen.mapInArrow(run, PREPARED)


def meet(rows: DataFrame, anchors: DataFrame, cells: int, primes: list[int], most: int, percent: int | None) -> DataFrame:
    """anchor, other, score: what the cells choose for the anchors.

    Without ``percent``: the best rows of the anchor's label and another id. With it: the best rows of
    other labels in each window that ends at one of the anchor's ``tops``.
    """
    none = F.array().cast("array<long>")
    cell = F.pmod(F.xxhash64("place"), F.lit(cells)).cast("int")
    stored = rows.select(cell.alias("cell"), F.lit(0).alias("kind"), "id", "label", "width", "components", none.alias("tops"))
    asking = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(1).alias("kind"),
        "id", "label", "width", "components", "tops" if percent is not None else none.alias("tops"),
    )
    dealt = stored.unionByName(asking).repartition(cells, "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows_of, at_cell = None, None
        for batch in batches:
            marks = np.asarray(batch.column("cell")).astype(np.int64) * 2 + np.asarray(batch.column("kind"))
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b == a:
                    continue
                part, (number, asks) = batch.slice(a, b - a), divmod(int(marks[a]), 2)
                if number != at_cell:
                    held, rows_of, at_cell = [], None, number
                if not asks:
                    held.append(part)
                    continue
                if rows_of is None:
                    rows_of, held = of_cell(held), []
                for start in range(0, len(part), BLOCK_ANCHORS):
                    yield chosen(rows_of, part.slice(start, BLOCK_ANCHORS), primes, most, percent)

    return dealt.mapInArrow(run, "anchor long, other long, score long")


def chosen(rows: dict[int, Vectors], anchors: pa.RecordBatch, primes: list[int], most: int, percent: int | None) -> pa.RecordBatch:
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    tops = anchors.column("tops").to_pylist()
    for length, (a_ids, a_labels, a_matrix, places) in by_length(anchors).items():
        kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in a_ids]
        if length not in rows:
            continue
        ids, labels, matrix, _ = rows[length]
        # A window below 0 ends before it begins.
        wanted = [[top for top in tops[place] if top >= 0] for place in places.tolist()]
        if percent is None:
            for label in np.unique(a_labels).tolist():
                asking = np.flatnonzero(a_labels == label)
                first, end = np.searchsorted(labels, label), np.searchsorted(labels, label, "right")
                for at in range(first, end, BLOCK_ROWS):
                    block = slice(at, min(end, at + BLOCK_ROWS))
                    scores = products(a_matrix[asking], matrix[block], primes)
                    for i, row in zip(asking.tolist(), scores, strict=True):
                        others = np.flatnonzero(ids[block] != a_ids[i])
                        near = others[best(row[others], ids[block][others], most)]
                        kept[i].append((ids[block][near], row[near]))
        else:
            for at in range(0, len(ids), BLOCK_ROWS):
                block = slice(at, at + BLOCK_ROWS)
                scores = products(a_matrix, matrix[block], primes)
                for i, row in enumerate(scores):
                    if not wanted[i]:
                        continue
                    inside = (100 * row >= percent * min(wanted[i])) & (row <= max(wanted[i]))
                    near = np.flatnonzero(inside & (labels[block] != a_labels[i]))
                    near = near[in_windows(row[near], ids[block][near], wanted[i], most, percent)]
                    kept[i].append((ids[block][near], row[near]))
        for i, parts in enumerate(kept):
            if not parts:
                continue
            ids, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(parts) > 1:
                near = best(scores, ids, most) if percent is None else in_windows(scores, ids, wanted[i], most, percent)
                ids, scores = ids[near], scores[near]
            out.append((np.full(len(ids), a_ids[i]), ids, scores))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "other", "score"])


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on a column ``id``, the 64-bit id. Rows take no part without an id, a label, or a
    vector, or if one of its components is unknown or not finite. Vectors meet those of their own length, the empty
    ones included, whose score is 0. Ties go to the smaller id. Rows with the anchor's id are not its others; other rows that repeat an id take part
    each for itself, and of anchors that repeat one the least by label and components asks. A positive below 0 has no
    negatives, as its window is empty. An empty table gives no rows; other columns are not read.
    Raises ValueError if a square norm is 2**55 or more.
    """
    spark = rows.sparkSession
    ship_package(spark)
    folder = run_folder(spark)
    as_label = F.col(label) if isinstance(label, str) else label
    ready = written(prepare(rows, id, vector, as_label, scale).withColumn("place", F.monotonically_increasing_id()), "vectors", folder)
    size, norm = ready.agg(F.sum(F.length("components")), F.max("norm")).first()
    primes = moduli(max(1, norm or 0))
    size = size or 0
    cells = max(1, -(-size // CELL_BYTES), min(2 * spark.sparkContext.defaultParallelism, size // LEAST_CELL_BYTES))
    asking = ready.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "width", "components")).alias("row")).select("id", "row.*")
    first = meet(ready, asking, cells, primes, positives, None)
    best_first = [F.col("score").desc(), F.col("other")]
    window = Window.partitionBy("anchor").orderBy(*best_first)
    found = written(
        first_per_group(first, ["anchor"], best_first, positives).withColumn("number", F.row_number().over(window)), "positives", folder
    )
    tops = found.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("tops"))
    second = meet(ready, asking.join(tops, "id"), cells, primes, negatives, percent)
    p = found.select("anchor", "number", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    inside = F.expr(f"{percent} * positive_score <= 100 * score and score <= positive_score")
    windows = second.join(p, "anchor").where(inside)
    kept = first_per_group(windows, ["anchor", "number"], best_first, negatives)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "number").orderBy(*best_first)))
    return ranked.select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
