"""Exact cosine top-k of query vectors over a corpus of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardlake.operators.dedupe import first_per_group
from wardlake.session import ship_package

# --- Fixed values ------------------------------------------------------------------
NORM_OFFSET = 1e-10  # added to a norm, so that a zero vector scores 0
TOP_K = 3
SCORE_DIGITS = 3
# ----------------------------------------------------------------------------------
# Bytes of vectors, as doubles, that a cell of the grid holds of either side.
CORPUS_BYTES = 128 << 20
QUERY_BYTES = 32 << 20
# Corpus rows and queries that a task scores at a time, which bound its score matrix.
SLICE = 1_024
QUERIES = 512
CELLS_PER_CORE = 2
# Scores are ranked at this precision: equal vectors tie whatever cell they are in.
RANK_DIGITS = 12
# Numbers of either side that are gathered at a time to score candidates one by one; beyond one pair in so many, all pairs
# of a slice are scored.
GATHERED = 1 << 20
DENSE = 16
# Stands for no id, which is the last of equal scores.
NO_ID = np.iinfo(np.int64).min


def comparable(vector: str = "embedding") -> Column:
    """Whether a vector can be compared: not empty, all elements known and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def left_out(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(length, row_count)`` of the vectors that cannot be compared with any."""
    bad = vectors.filter(~comparable(vector))
    return bad.groupBy(F.size(vector).alias("length")).agg(F.count(F.lit(1)).alias("row_count"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Equally long vectors as rows of floats or doubles, whichever they are; other numbers become doubles."""
    column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False)
    return rows.astype(rows.dtype if rows.dtype == np.float32 else np.float64, copy=False).reshape(len(column), -1)


def _divisors(rows: np.ndarray) -> np.ndarray:
    return np.linalg.norm(rows, axis=1, keepdims=True) + NORM_OFFSET


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64, copy=False)
    return rows / _divisors(rows)


class Held:
    """Vectors of a corpus with their ids. Their directions are held as floats, which find the candidates; the score of a
    candidate is then computed in doubles."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self._room = ids, vectors, np.empty(0, np.float32)
        self.floats, self.divisors = np.empty(vectors.shape, np.float32), np.empty((len(vectors), 1))
        for start in range(0, len(vectors), SLICE):
            rows = vectors[start : start + SLICE].astype(np.float64)
            self.divisors[start : start + SLICE] = _divisors(rows)
            self.floats[start : start + SLICE] = rows / self.divisors[start : start + SLICE]

    def room(self, queries: int, rows: int) -> np.ndarray:
        """Space for scores, used again by the next ones."""
        if len(self._room) < queries * rows:
            self._room = np.empty(queries * rows, np.float32)
        return self._room[: queries * rows].reshape(queries, rows)

    def units(self, at: slice | np.ndarray) -> np.ndarray:
        return self.vectors[at].astype(np.float64) / self.divisors[at]


class Asked:
    """Queries with the k best candidates that each has met so far: greatest score first, ties by greater id. Scores below
    ``limits`` are not wanted."""

    def __init__(self, units: np.ndarray, k: int, limits: np.ndarray | None = None):
        self.units, self.floats = units, units.astype(np.float32)
        self.score = np.full((len(units), k), -np.inf)
        self.ids = np.full((len(units), k), NO_ID, np.int64)
        self.limits = np.full(len(units), -np.inf) if limits is None else limits
        # More than rounding to floats, and summing as many products of them, can move the score of two directions.
        self.error = (units.shape[1] + 8) * 2.0**-23

    def meet(self, held: Held, start: int, end: int, asked: slice | np.ndarray = slice(None)) -> None:
        """Scores rows ``start`` to ``end`` for all queries, or for those ``asked``."""
        k, end = self.score.shape[1], min(end, len(held.ids))
        limit = np.maximum(self.score[asked, -1], self.limits[asked])
        floats = self.floats[asked]
        found = held.room(len(floats), end - start)
        np.matmul(floats, held.floats[start:end].T, out=found)
        bar = limit - self.error
        if end - start > k and bar.min(initial=0) == -np.inf:
            kth = np.partition(found, end - start - k, axis=1)[:, end - start - k]
            bar = np.maximum(bar, kth - 2 * self.error)
        bar = bar.astype(np.float32)
        # Most queries have no candidate in most slices.
        some = np.flatnonzero(found.max(axis=1, initial=-np.inf) >= bar)
        at = np.flatnonzero(found[some] >= bar[some, None])
        if not len(at):
            return
        query, row = np.divmod(at, end - start)
        query = some[query]
        if len(at) * DENSE > found.size:
            exact = (self.units[asked] @ held.units(slice(start, end)).T)[query, row]
        else:
            units, exact, step = self.units[asked], np.empty(len(at)), max(1, GATHERED // self.units.shape[1])
            for a in range(0, len(at), step):
                pairs = slice(a, a + step)
                exact[pairs] = np.einsum("ij,ij->i", units[query[pairs]], held.units(row[pairs] + start))
        exact = np.round(exact, RANK_DIGITS)
        kept = exact >= limit[query]
        self._admit(np.arange(len(self.score))[asked][query[kept]], exact[kept], held.ids[start:end][row[kept]])

    def _admit(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        touched, place = np.unique(query, return_inverse=True)
        place = np.r_[np.repeat(np.arange(len(touched)), k), place]
        score = np.r_[self.score[touched].ravel(), score]
        ids = np.r_[self.ids[touched].ravel(), ids]
        order = np.lexsort((ids, score, -place))[::-1]
        counts = np.bincount(place, minlength=len(touched))
        first = order[(np.cumsum(counts) - counts)[:, None] + np.arange(k)]
        self.score[touched], self.ids[touched] = score[first], ids[first]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, score and id of all candidates kept."""
        query, place = np.nonzero(self.score > -np.inf)
        return query, self.score[query, place], self.ids[query, place]


NOTHING = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))


def _top_of_cell(query_units: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """Top-k of every query over a cell: k rows per query are kept while it is scored."""
    firsts = range(0, len(query_units), QUERIES)
    held, blocks = Held(ids, vectors), [Asked(query_units[first : first + QUERIES], k) for first in firsts]
    for start in range(0, len(ids), SLICE):
        for block in blocks:
            block.meet(held, start, start + SLICE)
    best = [(query + first, score, found) for first, (query, score, found) in zip(firsts, (b.best() for b in blocks))]
    return tuple(np.concatenate(own) for own in zip(*best)) if best else NOTHING


def cosine_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    corpus_id: str = "note_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    corpus_bytes: int = CORPUS_BYTES,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``(query_id, corpus_id, score)`` of the k nearest corpus vectors of every query.

    Vectors are compared with those of their own length; which cannot be compared at all says
    ``comparable``, and ``left_out`` counts them. Corpus and queries are answered on a
    grid: either side is cut, by a hash of its unique ids, into parts of so many bytes,
    and a task multiplies one part of each. It gives k rows per query, of which every task of the
    next stage keeps k before the last shuffle; no pairs of rows are produced. The number of
    parts comes from the counts of each length, which Spark joins to the rows.

    Ids are integers on the corpus side and unique on both.
    """
    ship_package(corpus.sparkSession)
    out = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    schema = to_arrow_schema(out)
    sides = {}
    for name, frame, own in (("corpus", corpus, corpus_id), ("query", queries, query_id)):
        known = frame.filter(comparable(vector)).select(F.col(own).alias("_id"), F.col(vector).alias("_vector"))
        sides[name] = known.withColumn("_length", F.size("_vector"))

    def counts(name: str) -> DataFrame:
        return sides[name].groupBy("_length").agg(F.count(F.lit(1)).alias(f"{name}_rows"))

    def parts(name: str, cell: int) -> Column:
        return F.ceil(F.col(f"{name}_rows") * F.col("_length") * 8 / cell)

    # Few cells leave cores idle: queries are then cut further, into no less than what is scored at a time.
    enough = F.ceil(CELLS_PER_CORE * corpus.sparkSession.sparkContext.defaultParallelism / F.col("corpus_parts"))
    grid = counts("corpus").join(counts("query"), "_length").withColumn("corpus_parts", parts("corpus", corpus_bytes).cast("int"))
    some = F.greatest(parts("query", query_bytes), F.least(F.ceil(F.col("query_rows") / QUERIES), enough))
    grid = grid.select("_length", "corpus_parts", some.cast("int").alias("query_parts"))

    def spread(name: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("_id"), F.col(f"{name}_parts")).cast("int").alias(f"{name}_part")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{other}_part")
        rows = sides[name].join(grid, "_length").select("_length", "_id", "_vector", own, f"{other}_parts")
        return rows.select("_length", "_id", "_vector", f"{name}_part", every)

    def answer(corpus_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        if not corpus_rows.num_rows or not query_rows.num_rows:
            return schema.empty_table()
        ids = corpus_rows.column("_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
        vectors = _matrix(corpus_rows.column("_vector"))
        query, score, found = _top_of_cell(unit(_matrix(query_rows.column("_vector"))), ids, vectors, k)
        named = query_rows.column("_id").combine_chunks().take(pa.array(query, pa.int64()))
        keys = pa.array(found, mask=found == NO_ID).cast(schema.field(1).type)
        columns = [named.cast(schema.field(0).type), keys, pa.array(score, pa.float64())]
        return pa.Table.from_arrays(columns, schema=schema)

    cell = ["_length", "corpus_part", "query_part"]
    cells = spread("corpus", "query").groupBy(*cell).cogroup(spread("query", "corpus").groupBy(*cell))
    partial = cells.applyInArrow(answer, out)
    return first_per_group(partial, [query_id], [F.desc("score"), F.desc(corpus_id)], keep=k)
