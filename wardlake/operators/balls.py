"""Exact cosine top-k over a stored corpus, with cells that no bound admits left unread.

The corpus is stored in *cells*: each vector lies with the nearest of some pivots of its length, and a cell knows the
least and the greatest angle of its vectors to its pivot. Angles obey the triangle inequality, so the angle of a query
to any vector of a cell is at least its angle to the pivot less the greatest, and at least the least less its angle to
the pivot. A search scores the nearest cells until they hold k rows, which gives the score to beat, and then every
other cell that can still hold one as good. Answers are those of ``vectors.cosine_topk``, whatever the pivots are.

Neighbouring cells make up a *region* of so many bytes. A query goes to a region once, with a bitmap of the cells that it
visits there, so what is moved grows with the regions and not with the cells, however little the bounds rule out.

Vectors that are nearly zero have no angle to speak of: they are cell ``NO_ANGLE``, which every query visits, and a
query of that kind visits all cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardlake.operators.dedupe import first_per_group
from wardlake.operators.vectors import CELLS_PER_CORE, CORPUS_BYTES, QUERIES, QUERY_BYTES, SLICE, TOP_K, Asked, Held, _matrix, comparable, unit
from wardlake.session import ship_package

#: Pivots of one length: the square root of its rows, and no more than this. They are a layout, not a limit on results.
MOST_PIVOTS = 1_024
#: Bytes of queries, as doubles, that pass by one reading of a region; beyond them it is read again elsewhere.
PASS_BYTES = 32 << 20
#: Queries that a task compares with all cells: every one of them may be admitted to every cell.
QUERY_ROWS = 2_048
NO_ANGLE = -1
LEAST_NORM = 1e-4
#: What rounding, and the offset that is added to norms, can move a bound by.
SLACK = 1e-5
GRID = ["length", "region", "part", "pass"]


class Found(NamedTuple):
    """``hits``: query, key and score. ``visits``: query, length and cell of every cell that was scored, spelled out of
    bitmaps when it is read."""

    hits: DataFrame
    visits: DataFrame


def _rows(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = batch.column(name)
    return _matrix(column if isinstance(column, pa.ChunkedArray) else pa.chunked_array([column]))


def _directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their norm, and which of them have a direction."""
    rows = rows.astype(np.float64, copy=False)
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norm, LEAST_NORM), norm[:, 0] >= LEAST_NORM


def _parts(rows: str, size: int):
    """Into how many parts of ``size`` bytes so many vectors go."""
    return F.ceil(F.col(rows) * F.col("length") * 8 / size).cast("int")


def _query_parts(rows: str, size: int):
    """Into how many parts queries go: of ``size`` bytes, and of ``QUERY_ROWS`` rows, at most."""
    return F.greatest(_parts(rows, size), F.ceil(F.col(rows) / QUERY_ROWS).cast("int"))


def _share(column: str, parts: str):
    return F.pmod(F.xxhash64(column), F.col(parts)).cast("int")


def _every(parts: str):
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


class BallIndex:
    """Vectors by a unique integer key, in cells below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str = "note_id", vector: str = "embedding"):
        self.spark, self.root, self.key, self.vector = spark, root, key, vector

    def _known(self, rows: DataFrame, own: str) -> DataFrame:
        """id, vector and length of the vectors that can be compared."""
        known = rows.where(comparable(self.vector) & F.col(own).isNotNull())
        return known.select(F.col(own).alias("id"), F.col(self.vector).alias("vector")).withColumn("length", F.size("vector"))

    def _written(self, frame: DataFrame, path: str, *folders: str) -> DataFrame:
        frame.write.mode("overwrite").partitionBy(*folders).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def cells(self) -> DataFrame:
        """length, cell, row_count, least and greatest angle, pivot (null: ``NO_ANGLE``)."""
        return self.spark.read.parquet(f"{self.root}/cells")

    def members(self) -> DataFrame:
        """id, vector, length, cell; the last two are folders."""
        held = self.cells().schema["pivot"].dataType
        schema = T.StructType([*_fields("id long"), T.StructField("vector", held), *_fields("length int, cell int")])
        return self.spark.read.schema(schema).parquet(f"{self.root}/members")

    def build(self, corpus: DataFrame, part_bytes: int = CORPUS_BYTES) -> None:
        """Vectors that cannot be compared, and rows without a key, are left out. No rows make an empty index."""
        ship_package(self.spark)
        known = self._known(corpus, self.key).withColumn("id", F.col("id").cast("long"))
        counts = known.groupBy("length").agg(F.count(F.lit(1)).alias("row_count"))
        counts = counts.withColumn("parts", _parts("row_count", part_bytes))
        square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
        any_order = [F.xxhash64("id"), F.col("id")]
        drawn = first_per_group(known.where(square >= LEAST_NORM**2), ["length"], any_order, keep=MOST_PIVOTS)
        # Equal vectors drawn more than once are one pivot.
        drawn = drawn.groupBy("length", "vector").agg(F.min("id").alias("id")).join(counts, "length")
        place = F.row_number().over(Window.partitionBy("length").orderBy(*any_order))
        chosen = drawn.withColumn("place", place).where(F.col("place") <= F.ceil(F.sqrt("row_count")))
        pivots = self._written(chosen.select("length", "place", "vector"), f"{self.root}/pivots")

        rows = known.join(counts, "length").withColumn("part", _share("id", "parts")).drop("parts", "row_count")
        beside = pivots.join(counts, "length").select("length", "place", "vector", _every("parts").alias("part"))
        cut = rows.groupBy("length", "part").cogroup(beside.groupBy("length", "part"))
        placed = self._written(cut.applyInArrow(_nearest, "id long, length int, cell int, angle double"), f"{self.root}/places")

        cells = placed.groupBy("length", "cell").agg(
            F.count(F.lit(1)).alias("row_count"), F.min("angle").alias("least"), F.max("angle").alias("greatest")
        )
        named = pivots.select("length", F.col("place").alias("cell"), F.col("vector").alias("pivot"))
        cells = self._written(cells.join(named, ["length", "cell"], "left"), f"{self.root}/cells")

        shares = cells.select("length", "cell", _parts("row_count", part_bytes).alias("parts"))
        members = known.join(placed.drop("angle", "length"), "id").join(shares, ["length", "cell"])
        members = members.withColumn("part", _share("id", "parts")).repartition("length", "cell", "part")
        self._written(members.select("id", "vector", "length", "cell"), f"{self.root}/members", "length", "cell")

    def _regions(self, part_bytes: int) -> DataFrame:
        """length, cell, region, first, parts: into which region each cell goes, its first cell, and into how many parts."""
        size, own = F.col("row_count") * F.col("length") * 8, Window.partitionBy("length", "region")
        before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        region = F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / part_bytes).cast("int")
        parts = F.ceil(F.sum(size).over(own) / part_bytes).cast("int")
        placed = self.cells().withColumn("region", region)
        return placed.select("length", "cell", "region", F.min("cell").over(own).alias("first"), parts.alias("parts"))

    def _visits(self, queries: DataFrame, k: int, query_bytes: int, part_bytes: int) -> DataFrame:
        """id, length, region, first, cells: where the queries go, a bit for each cell from ``first`` on. Without a
        ``limit``, to the nearest cells that hold k rows together; with one, to all cells that may hold a score of it but
        those in ``near``."""
        counts = queries.groupBy("length").agg(F.count(F.lit(1)).alias("_rows"))
        parts = counts.select("length", _query_parts("_rows", query_bytes).alias("parts"))
        asked = queries.join(parts, "length").withColumn("part", _share("id", "parts")).drop("parts")
        regions = self._regions(part_bytes).drop("parts")
        cells = self.cells().join(regions, ["length", "cell"]).join(parts, "length").withColumn("part", _every("parts")).drop("parts")
        schema = T.StructType([T.StructField("id", queries.schema["id"].dataType), *_fields(VISIT)])
        out = to_arrow_schema(schema)

        def go(asked: pa.Table, cells: pa.Table) -> pa.Table:
            if not asked.num_rows or not cells.num_rows:
                return out.empty_table()
            cells = cells.sort_by("cell")
            found = [out.empty_table()]
            for start in range(0, asked.num_rows, QUERIES):
                some = asked.slice(start, QUERIES)
                goes = _admitted(some, cells, k)
                found += [
                    pa.table([some.column("id").take(query), some.column("length").take(query), *columns], schema=out)
                    for query, *columns in _bitmaps(goes, cells)
                ]
            return pa.concat_tables(found)

        return asked.groupBy("length", "part").cogroup(cells.groupBy("length", "part")).applyInArrow(go, schema)

    def _scored(self, visits: DataFrame, queries: DataFrame, k: int, part_bytes: int) -> DataFrame:
        """id, key, score: k rows of every query and region, or fewer. A task holds one part of a region; queries pass by."""
        regions = self._regions(part_bytes)
        spans = regions.groupBy("length", "region").agg(F.first("parts").alias("parts"))
        passes = visits.groupBy("length", "region").agg(F.count(F.lit(1)).alias("_rows"))
        # Few regions leave cores idle: queries are then cut into more passes.
        cores = CELLS_PER_CORE * self.spark.sparkContext.defaultParallelism
        spans = spans.withColumn("enough", F.ceil(cores / F.sum("parts").over(Window.partitionBy("length"))))
        many = F.greatest(_parts("_rows", PASS_BYTES), F.least(F.ceil(F.col("_rows") / QUERIES), "enough")).cast("int")
        passes = passes.join(spans, ["length", "region"]).select("length", "region", "parts", many.alias("passes"))
        limit = F.col("limit") if "limit" in queries.columns else F.lit(float("-inf"))
        asked = visits.join(queries.select("id", "vector", limit.alias("limit")), "id").join(passes, ["length", "region"])
        vector, unknown = F.col("vector"), lambda kind: F.lit(None).cast(kind)
        if queries.schema["vector"].dataType != self.members().schema["vector"].dataType:
            vector = vector.cast("array<double>")
        asked = asked.select(
            "length", "region", _every("parts").alias("part"), _share("id", "passes").alias("pass"), F.lit(1).alias("kind"),
            F.col("id").alias("query"), unknown("long").alias("key"), unknown("int").alias("cell"), "first", "cells", "limit",
            vector.alias("vector"),
        )
        held = self.members().join(regions.drop("parts"), ["length", "cell"]).join(passes, ["length", "region"])
        held = held.withColumn("part", _share("id", "parts")).select(
            "length", "region", "part", _every("passes").alias("pass"), F.lit(0).alias("kind"),
            unknown(queries.schema["id"].dataType).alias("query"), F.col("id").alias("key"), "cell", "first",
            unknown("binary").alias("cells"), unknown("double").alias("limit"), vector.alias("vector"),
        )
        # Queries of the same cells pass by together.
        both = held.unionByName(asked).repartition(*GRID).sortWithinPartitions(*GRID, "kind", "cell", "cells")
        schema = T.StructType([T.StructField("id", queries.schema["id"].dataType), *_fields("key long, score double")])
        out = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, rows_of, cells_of, held = None, [], [], None
            for batch in batches:
                if not batch.num_rows:
                    continue
                grid = np.stack([batch.column(name).to_numpy() for name in [*GRID, "kind"]], axis=1)
                edges = np.flatnonzero((grid[1:] != grid[:-1]).any(axis=1)) + 1
                for a, b in zip([0, *edges], [*edges, len(grid)], strict=True):
                    rows, place = batch.slice(a, b - a), tuple(grid[a][:-1])
                    if place != at:
                        at, rows_of, cells_of, held = place, [], [], None
                    if grid[a][-1] == 0:
                        rows_of.append((rows.column("key").to_numpy(), _rows(rows, "vector")))
                        cells_of.append(rows.column("cell").to_numpy())
                        continue
                    if held is None and rows_of:
                        held, rows_of = Held(*map(np.concatenate, zip(*rows_of, strict=True))), []
                        cells_of = _runs(np.concatenate(cells_of))
                    if held is None:  # no row of the region has this part
                        continue
                    for start in range(0, rows.num_rows, QUERIES):
                        some = rows.slice(start, QUERIES)
                        asked = Asked(unit(_rows(some, "vector")), k, some.column("limit").to_numpy())
                        goes = _bits(some.column("cells"))
                        first = some.column("first")[0].as_py()
                        for cell, begin, end in cells_of:
                            query = np.flatnonzero(goes[:, cell - first])
                            for row in range(begin, end if len(query) else begin, SLICE):
                                asked.meet(held, row, min(row + SLICE, end), query)
                        query, score, key = asked.best()
                        columns = [some.column("query").take(pa.array(query)), pa.array(key), pa.array(score)]
                        yield pa.RecordBatch.from_arrays(columns, schema=out)

        return both.mapInArrow(run, schema)

    def search(
        self,
        queries: DataFrame,
        folder: str,
        k: int = TOP_K,
        query_id: str = "query_id",
        part_bytes: int = CORPUS_BYTES,
        query_bytes: int = QUERY_BYTES,
    ) -> Found:
        """The k best rows of every query, ties by greater key, and the cells visited for them.

        Query ids are unique. Queries that cannot be compared, have no id, or have a length of their own get no row. The
        first round's visits and scores are written below ``folder``, since the second starts from them.
        """
        ship_package(self.spark)
        known = self._known(queries, query_id)
        best = lambda rows: first_per_group(rows, ["id"], [F.desc("score"), F.desc("key")], keep=k)
        near = self._written(self._visits(known, k, query_bytes, part_bytes), f"{folder}/near")
        first = self._written(best(self._scored(near, known, k, part_bytes)), f"{folder}/first")
        # A query with fewer than k rows by now has been to all cells of its length.
        limit = first.groupBy("id").agg(F.min("score").alias("limit"))
        # A query has been to k cells with a pivot, and the one without, at most.
        been = _spelled(near).groupBy("id").agg(F.collect_set("cell").alias("near"))
        open_ = known.join(limit, "id").join(been, "id")
        rest = self._written(self._visits(open_, k, query_bytes, part_bytes), f"{folder}/rest")
        hits = best(first.unionByName(self._scored(rest, open_, k, part_bytes)))
        return Found(
            hits.select(F.col("id").alias(query_id), F.col("key").alias(self.key), "score"),
            _spelled(near.unionByName(rest)).withColumnRenamed("id", query_id),
        )


VISIT = "length int, region int, first int, cells binary"


def _fields(schema: str) -> list[T.StructField]:
    return T.StructType.fromDDL(schema).fields


def _bitmaps(goes: np.ndarray, cells: pa.Table) -> Iterator[tuple]:
    """For each region that any query goes to: the queries' rows, the region, its first cell and bitmaps of its cells from
    there on. ``cells`` are sorted."""
    numbers = cells.column("cell").to_numpy()
    for region, begin, end in _runs(cells.column("region").to_numpy()):
        query = np.flatnonzero(goes[:, begin:end].any(axis=1))
        if not len(query):
            continue
        bits = np.zeros((len(query), numbers[end - 1] - numbers[begin] + 1), bool)
        bits[:, numbers[begin:end] - numbers[begin]] = goes[query, begin:end]
        packed = np.packbits(bits, axis=1)
        held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(packed.shape[1]), len(packed), [None, pa.py_buffer(packed.tobytes())])
        same = [pa.array(np.full(len(query), value, np.int32)) for value in (region, numbers[begin])]
        yield pa.array(query), *same, held.cast(pa.binary())


def _bits(bitmaps: pa.Array) -> np.ndarray:
    """Bitmaps of one region as rows."""
    return np.unpackbits(np.frombuffer(b"".join(bitmaps.to_pylist()), np.uint8).reshape(len(bitmaps), -1), axis=1)


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """Each run of equal values: the value, where it begins, and where it ends."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return [(int(values[a]), a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _spelled(visits: DataFrame) -> DataFrame:
    """id, length, cell: a row for each bit of the visits."""
    schema = T.StructType([visits.schema["id"], *_fields("length int, cell int")])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Few rows at a time, each of which may have as many cells as there are.
            for start in range(0, batch.num_rows, QUERIES):
                some = batch.slice(start, QUERIES)
                bitmaps, first = some.column("cells").to_pylist(), some.column("first").to_numpy()
                cells = [np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8))) for bitmap in bitmaps]
                row = pa.array(np.repeat(np.arange(len(cells)), [len(found) for found in cells]))
                cell = np.concatenate([found + at for found, at in zip(cells, first, strict=True)]).astype(np.int32)
                columns = [some.column("id").take(row), some.column("length").take(row), pa.array(cell)]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return visits.mapInArrow(run, schema)


def _nearest(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """id, length, cell, angle: the pivot that is nearest to each row."""
    names = ["id", "length", "cell", "angle"]
    cell, angle = np.full(rows.num_rows, NO_ANGLE, np.int32), np.zeros(rows.num_rows)
    if rows.num_rows and pivots.num_rows:
        pivots = pivots.sort_by("place")
        places, axes = pivots.column("place").to_numpy(), _directions(_rows(pivots, "vector"))[0]
        for start in range(0, rows.num_rows, SLICE):
            part, has = _directions(_rows(rows.slice(start, SLICE), "vector"))
            cosine = part @ axes.T
            at = cosine.argmax(axis=1)
            found = np.arccos(np.clip(cosine[np.arange(len(at)), at], -1, 1))
            cell[start : start + SLICE] = np.where(has, places[at], NO_ANGLE)
            angle[start : start + SLICE] = np.where(has, found, 0)
    columns = [rows.column("id"), rows.column("length"), pa.array(cell), pa.array(angle)]
    return pa.table(columns, names=names)


def _admitted(asked: pa.Table, cells: pa.Table, k: int) -> np.ndarray:
    """Which queries go to which cells."""
    cells_of = cells.column("cell").to_numpy()
    count, least, greatest = (cells.column(name).to_numpy() for name in ("row_count", "least", "greatest"))
    has_pivot = cells_of != NO_ANGLE
    rows, has = _directions(_rows(asked, "vector"))
    bound = np.ones((len(rows), len(cells_of)))
    if has_pivot.any():
        axes = _directions(_rows(cells.filter(pa.array(has_pivot)), "pivot"))[0]
        angle = np.arccos(np.clip(rows @ axes.T, -1, 1))
        nearest = np.maximum(np.maximum(angle - greatest[has_pivot], least[has_pivot] - angle), 0)
        bound[:, has_pivot] = np.where(has[:, None], np.cos(np.minimum(nearest, np.pi)), 1)
    if "limit" in asked.column_names:
        goes = bound + SLACK >= asked.column("limit").to_numpy()[:, None]
        near = asked.column("near").combine_chunks()
        been = np.repeat(np.arange(len(rows)), near.value_lengths().to_numpy())
        goes[been, np.searchsorted(cells_of, near.flatten().to_numpy())] = False
        return goes
    # Cells without an angle first, then the nearest pivots, until k rows lie before the next.
    order = np.argsort(np.where(has_pivot, -bound, -2), axis=1, kind="stable")
    held = np.where(has_pivot, count, 0)[order]
    before = np.cumsum(held, axis=1) - held
    goes = np.zeros(bound.shape, bool)
    np.put_along_axis(goes, order, before < k, axis=1)
    return goes
