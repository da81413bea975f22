"""What the corpus operators share: input columns, folds and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.encoding import slices
from wardlake.session import run_folder, ship_package

# What separates words (space, and tab to carriage return).
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Whether Spark drops the shuffle files of an execution once it has ended.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of an Arrow batch: both Spark and Python hold a few for every running task.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long), text (null as empty) and the columns named; tasks get this package."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def rows_where(docs: DataFrame, decide: Callable[[pa.RecordBatch], np.ndarray], **more: Column) -> DataFrame:
    """The rows of ``docs``, whatever their columns, for which ``decide`` says so. It is given batches of whole texts
    (``text``: null as empty) and the columns ``more``. Every row is decided on its own: ids may be null or repeat,
    and nothing is shuffled."""
    ship_package(docs.sparkSession)
    kept, given_as, names = docs.schema, ["text", *more], ["_text", *[f"_{name}" for name in more]]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    asked = docs.withColumns({"_text": text} | {f"_{name}": column for name, column in more.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                given = batch.select(names).rename_columns(given_as)
                yield batch.select(kept.names).filter(pa.array(decide(given), pa.bool_()))

    return asked.mapInArrow(run, kept)


def written(frame: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The frame, written once in the shared folder and read again: what follows neither repeats
    the work nor depends on the executor that did it. Nothing reads the shuffles of the write again, so they go at its end."""
    spark = frame.sparkSession
    path = f"{folder or run_folder(spark)}/{name}"
    options = {DROP_SHUFFLES: "true", ARROW_BYTES: str(BATCH_BYTES)}
    before = {option: spark.conf.get(option, None) for option in options}
    for option, value in options.items():
        spark.conf.set(option, value)
    try:
        frame.write.mode("overwrite").parquet(path)
    finally:
        for option, value in before.items():
            spark.conf.unset(option) if value is None else spark.conf.set(option, value)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """The frame with the place of every row in ``order``, from 0. Rows that are equal in ``order`` get their
    places in any order. No task sorts more than its range: the rows before each range are added up
    from one count per task."""
    at = "_at"
    ranges = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranges.withColumn(at, F.monotonically_increasing_id()), f"by-{name}")
    task = F.shiftright(at, 33)  # the upper bits of an increasing id are its task's number
    counts = sorted(placed.groupBy(task.alias("task")).count().collect())
    before, starts = 0, []
    for number, count in counts:
        starts.append((number, before - (number << 33)))
        before += count
    shift = frame.sparkSession.createDataFrame(starts, "_task LONG, _shift LONG")
    joined = placed.join(F.broadcast(shift), task == F.col("_task"))
    return joined.withColumn(name, F.col(at) + F.col("_shift")).drop(at, "_task", "_shift")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
