"""Health figures of the log and of the layers, as metric rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.splits import SplitTable
from wardlake.sources.versioned import CommittedTable

# Age from which a mart is stale, and the age of an undated one.
FRESH_MINUTES = 30
UNKNOWN_AGE = -1.0
UNREADABLE = -1


def topic_offsets(log: DataFrame) -> DataFrame:
    """Next offset, first offset and message count per topic partition of a captured log."""
    ends = log.groupBy("topic", "partition").agg(
        F.min("offset").alias("earliest_offset"), (F.max("offset") + 1).alias("latest_offset")
    )
    return ends.withColumn("total_messages", F.col("latest_offset") - F.col("earliest_offset"))


def topic_totals(log: DataFrame) -> DataFrame:
    """The same per topic over all its partitions."""
    return topic_offsets(log).groupBy("topic").agg(
        F.sum("latest_offset").alias("latest_offset"),
        F.sum("total_messages").alias("total_messages"),
    )


def topic_health(log: DataFrame | None, topics: Iterable[str]) -> DataFrame:
    """Latest offset and messages of each topic of a captured log (topic, partition, offset); a topic
    of which nothing can be read has -1 for both."""
    spark = SparkSession.active() if log is None else log.sparkSession
    named = spark.createDataFrame([(t,) for t in topics], "topic STRING")
    empty = spark.createDataFrame([], "topic STRING, latest_offset BIGINT, total_messages BIGINT")
    found = named.join(empty if log is None else topic_totals(log), "topic", "left")
    return found.select(
        "topic", *[F.coalesce(name, F.lit(UNREADABLE)).alias(name) for name in ("latest_offset", "total_messages")]
    )


def published_health(
    spark: SparkSession, base: str, marts: Iterable[str], now: dt.datetime | Column | None = None
) -> DataFrame:
    """The rows of ``layer_health`` for published marts, from what their commits tell: the manifest of a split table has
    its rows and its stamp; of other tables the row groups' footers have the count, and the greatest stamp is that
    of any row. No data page of a split table is read; a mart that isn't there is left out."""
    rows, others = [], {}
    for name in marts:
        table = SplitTable(spark, f"{base}/gold/{name}")
        files, about = table.manifest()
        if about:
            micros = max(about.get("stamp", {}).values(), default=None)
            count = sum(f.rows - f.marked for f in files)
            # A mart without rows has no newest row.
            rows.append((name, count, micros if count else None))
            continue
        whole = CommittedTable(spark, f"{base}/gold/{name}").read()
        if whole is not None:
            others[name] = whole
    told = spark.createDataFrame(rows, "table_name STRING, row_count LONG, micros LONG").select(
        F.lit("gold").alias("layer"), "table_name", "row_count", F.timestamp_micros("micros").alias("_newest")
    )
    health = _aged(told, now)
    return health.unionByName(layer_health(others, now=now)) if others else health


def _aged(figures: DataFrame, now: dt.datetime | Column | None) -> DataFrame:
    """Age and status of tables of which the newest stamp is known."""
    micros = F.unix_micros(_moment(now)) - F.unix_micros("_newest")
    minutes = F.round(micros / 60_000_000, 1)
    aged = figures.withColumn("age_minutes", F.coalesce(minutes, F.lit(UNKNOWN_AGE)))
    status = (
        F.when(F.col("_newest").isNull(), "unknown")
        .when(F.col("age_minutes") < FRESH_MINUTES, "ok")
        .otherwise("stale")
    )
    return aged.select("layer", "table_name", "row_count", "age_minutes", status.alias("status"))


def _moment(now: dt.datetime | Column | None) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def table_health(
    df: DataFrame,
    layer: str,
    name: str,
    computed_at: str | None = "gold_computed_at",
    now: dt.datetime | Column | None = None,
) -> DataFrame:
    """Row count and age of one table, from one aggregate. A table without a time column
    has age -1 and the status unknown; from 30 minutes on it is stale."""
    rows = F.count(F.lit(1)).alias("row_count")
    if computed_at is None or computed_at not in df.columns:
        figures = df.agg(rows).withColumn("_newest", F.lit(None).cast("timestamp"))
    else:
        figures = df.agg(rows, F.max(computed_at).alias("_newest"))
    return _aged(figures.withColumns({"layer": F.lit(layer), "table_name": F.lit(name)}), now)


def layer_health(
    gold: dict[str, DataFrame],
    bronze: dict[str, DataFrame] | None = None,
    now: dt.datetime | Column | None = None,
) -> DataFrame:
    """Health of every mart and the size of every Bronze table."""
    checks = []
    for name, df in gold.items():
        stamp = "alert_generated_at" if "alert_generated_at" in df.columns else "gold_computed_at"
        checks.append(table_health(df, "gold", name, stamp, now))
    for name, df in (bronze or {}).items():
        checks.append(
            table_health(df, "bronze", name, None, now).withColumn("status", F.lit("ok"))
        )
    health = checks[0]
    for check in checks[1:]:
        health = health.unionByName(check)
    return health


def as_metric_rows(health: DataFrame, now: dt.datetime | Column | None = None) -> DataFrame:
    """Layer health in the common metric shape: one row per figure."""
    figures = F.array(
        F.struct(F.lit("row_count").alias("metric"), F.col("row_count").cast("double").alias("value")),
        F.struct(F.lit("age_minutes").alias("metric"), F.col("age_minutes").alias("value")),
    )
    return health.select(
        _moment(now).alias("ts"),
        F.concat_ws(".", "layer", "table_name").alias("entity"),
        F.col("status").alias("tag"),
        F.inline(figures),
    ).select("ts", "entity", "metric", "value", "tag")
