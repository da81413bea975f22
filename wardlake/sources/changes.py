"""Change-log readers: broker topics, or a landing folder of the same records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.operators.dedupe import first_per_group
from wardlake.operators.merge import OP, change_op
from wardlake.schemas import CHANGE_RECORD, SOURCE_TABLES, SourceTable, union_schema

#: Records of a log that one task orders at a time.
BIN_RECORDS = 1 << 16


def kafka_options(
    servers: str,
    topics: list[str],
    starting: str = "earliest",
    records_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options for one query over one or several topics."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, topics: list[str], **limits) -> DataFrame:
    """A topic stream with text key and value (needs the Kafka connector on the classpath)."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **limits))
    return stream.load().select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def read_landing(
    spark: SparkSession, path: str, topics: list[str] | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """The same records as JSON lines in a folder, read as a stream."""
    stream = spark.readStream.schema(CHANGE_RECORD)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    records = stream.json(path)
    return records.filter(F.col("topic").isin(*topics)) if topics else records


def _finish(parsed: DataFrame) -> DataFrame:
    known = parsed.columns
    return parsed.withColumn(OP, change_op(known)).drop("__op", "__deleted", "__table")


def parse_union(records: DataFrame) -> DataFrame:
    """Records of any topic through the one wide schema, with topic and broker time."""
    payload = records.withColumn("_row", F.from_json("value", union_schema()))
    return payload.select("_row.*", "topic", F.col("timestamp").alias("kafka_ts"))


def parse_table(records: DataFrame, table: SourceTable, *more: Column) -> DataFrame:
    """Records of one topic through its own schema, ready for the Bronze rules, with ``more`` columns of them.

    The position in the log is kept: it orders versions that share a pipeline time.
    """
    payload = records.withColumn("_row", F.from_json("value", table.wire))
    return _finish(
        payload.select(
            "_row.*",
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            *more,
        )
    )


def route(records: DataFrame, tables: dict[str, SourceTable] = SOURCE_TABLES) -> dict[str, DataFrame]:
    """Split a mixed stream into one parsed frame per table."""
    return {
        name: parse_table(records.filter(F.col("topic") == table.topic), table)
        for name, table in tables.items()
    }


def to_records(rows: DataFrame, table: SourceTable, offset: str, timestamp) -> DataFrame:
    """Encode table rows as change records (the inverse of ``parse_table``), for landing files."""
    names = [f.name for f in table.wire.fields if f.name in rows.columns]
    return rows.select(
        F.lit(table.topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col(offset).cast(T.LongType()).alias("offset"),
        timestamp.alias("timestamp"),
        F.col(table.key).cast("string").alias("key"),
        F.to_json(F.struct(*names)).alias("value"),
    )


def waiting_records(spans: DataFrame, after: DataFrame) -> DataFrame:
    """topic, partition, offset of the records beyond the last offset that an earlier batch took of their partition."""
    waiting = spans.join(after.select("topic", "partition", F.col("to_offset").alias("_done")), ["topic", "partition"], "left")
    return waiting.where("_done IS NULL OR offset > _done").select("topic", "partition", "offset")


def all_waiting(spans: DataFrame, after: DataFrame) -> DataFrame:
    """The range of each partition that holds all that waits, in the columns of ``admitted``."""
    return waiting_records(spans, after).groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), F.max("offset").alias("to_offset"), F.count(F.lit(1)).alias("records")
    )


def in_batches(log: DataFrame, ranges: DataFrame, records: int, bin_records: int = BIN_RECORDS) -> DataFrame:
    """The records of a log in ``ranges`` (see ``admitted``) with ``batch``, from 0: ``records`` of a topic in each but the last.

    A partition's records keep their order, and those of a topic's partitions are mixed evenly: the i-th of n stands at
    i - 1/2 parts of n. How many of another partition stand before it follows from the counts alone, so records are
    ordered within bins of their partition's offsets only, of about ``bin_records`` each.
    """
    width = F.greatest(F.expr(f"(to_offset - from_offset + 1) div greatest(1, records div {bin_records})"), F.lit(1))
    beside = F.collect_list(F.struct("partition", "records")).over(Window.partitionBy("topic"))
    # One row per partition.
    ranges = ranges.withColumns({"_width": width, "_beside": beside}).withColumnRenamed("records", "_own")
    chosen = log.join(F.broadcast(ranges), ["topic", "partition"]).where(F.col("offset").between(F.col("from_offset"), F.col("to_offset")))
    binned = chosen.withColumn("_bin", F.expr("(offset - from_offset) div _width"))
    bins = binned.groupBy("topic", "partition", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("topic", "partition").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("topic", "partition", "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("topic", "partition", "_bin").orderBy("offset"))
    placed = binned.withColumn("_inside", inside).join(bins, ["topic", "partition", "_bin"]).withColumn("_place", F.col("_before") + F.col("_inside"))
    # Of a partition with m records, those j with (2j - 1) / m < (2i - 1) / n; an equal one first by partition.
    ahead = """aggregate(_beside, 0L, (s, q) -> s + if(q.partition = partition, _place,
        ((2 * _place - 1) * q.records + _own - if(q.partition < partition, 0, 1)) div (2 * _own)))"""
    numbered = placed.withColumn("batch", F.expr(f"({ahead} - 1) div {int(records)}"))
    return numbered.select(*log.columns, "batch")


def admitted(spans: DataFrame, after: DataFrame, records: int) -> DataFrame:
    """The next range of each partition of a log, so that no topic gets more than ``records``.

    ``spans`` has topic, partition, offset of the records that are there, ``after`` the last offset of each
    partition that an earlier batch took. A topic's limit is shared among its partitions in proportion to what they have
    waiting; one whose share is below a record waits until the others have less. Offsets may have gaps, and are
    unique in their partition. Returns topic, partition, from_offset, to_offset, records.
    """
    waiting = waiting_records(spans, after)
    counts = waiting.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
    by_topic = Window.partitionBy("topic")
    earlier = by_topic.orderBy("partition").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Shares are differences of rounded running sums, so that they add up to the limit exactly.
    whole = F.sum("n").over(by_topic)
    limit = F.least(whole, F.lit(records))
    upto = F.expr("cast(_upto as decimal(38,0)) * _limit div _whole").cast("long")
    shared = counts.withColumns({"_upto": F.sum("n").over(earlier), "_whole": whole, "_limit": limit}).withColumn("_to", upto)
    ordered = by_topic.orderBy("partition")
    shares = shared.withColumn("share", F.col("_to") - F.coalesce(F.lag("_to").over(ordered), F.lit(0)))
    shares = shares.where("share > 0").select("topic", "partition", "share")
    # No share is above the limit: tasks send that many rows of a partition at most.
    ranked = first_per_group(waiting, ["topic", "partition"], ["offset"], records)
    ranked = ranked.withColumn("_place", F.row_number().over(Window.partitionBy("topic", "partition").orderBy("offset")))
    taken = ranked.join(shares, ["topic", "partition"]).where("_place <= share")
    return taken.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), F.max("offset").alias("to_offset"), F.count(F.lit(1)).alias("records")
    )
