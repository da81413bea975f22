"""Exact deduplication as a stream with keyed state on disk.

The documents pass through Structured Streaming in bounded micro-batches. The state, kept by
RocksDB and saved with every batch in the shared checkpoint folder, has one entry per digest of a
text: how many rows had it, and the largest ``(doc_id, locator)`` among them. There is no watermark,
so entries never expire, and a later run that names the same checkpoint goes on where this one ended.
Copies are counted before the shuffle; a text with a third of all rows sends one row per task.

A digest only nominates: whatever shares an entry is compared byte by byte with the text of the
entry's keeper. Entries in which some text differs are taken apart by whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.base import written
from wardlake.session import run_folder

STORE = "spark.sql.streaming.stateStore"
#: State on disk; batches save what they changed, and files are not given room in advance, which for
#: many small stores would be most of their size.
STATE_OPTIONS = {
    f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STORE}.rocksdb.allowFAllocate": "false",
    f"{STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{STORE}.rocksdb.maxMemoryUsageMB": "128",
}
#: Bytes of files that one core takes in a micro-batch.
BATCH_BYTES_PER_CORE = 64 << 20


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def with_key(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "digest", digest(F.col("text"))
    )


def update_state(stream: DataFrame, checkpoint: str, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """Run all that the stream offers into the state below ``checkpoint`` and return the state:
    digest, keep_id, locator (the keeper's file), group_size.

    ``stream`` is a file stream with doc_id and text.
    """
    spark = stream.sparkSession
    before = {option: spark.conf.get(option, None) for option in STATE_OPTIONS}
    for option, value in STATE_OPTIONS.items():
        spark.conf.set(option, value)
    try:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        keyed = stream.select(
            digest(text).alias("digest"),
            F.struct(
                F.col("doc_id").cast("long").alias("doc_id"),
                F.col("_metadata.file_path").alias("locator"),
            ).alias("row"),
        )
        state = keyed.groupBy("digest").agg(F.max("row").alias("keeper"), F.count(F.lit(1)).alias("group_size"))
        query = (
            state.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for option, value in before.items():
            spark.conf.unset(option) if value is None else spark.conf.set(option, value)
    value = spark.read.format("statestore").load(checkpoint).select("key.digest", "value.*")
    _, keeper, size = value.columns  # the buffers of max and count, in the order of the aggregates
    return value.select(
        "digest",
        F.col(f"`{keeper}`.doc_id").alias("keep_id"),
        F.col(f"`{keeper}`.locator").alias("locator"),
        F.col(f"`{size}`").alias("group_size"),
    )


def open_stream(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path`` as a stream, in micro-batches sized for the cluster."""
    batch = BATCH_BYTES_PER_CORE * max(1, spark.sparkContext.defaultParallelism)
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    # A stream takes a pattern where it would not take the path of a single file.
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch)).parquet(pattern)


def earlier_keepers(spark: SparkSession, state: DataFrame, keyed: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """digest, keep_id and text of the keepers that entries of ``keyed`` rows have from earlier runs, read from the
    files that their locators name."""
    asked = keyed.select("digest", "doc_id").distinct()
    here = asked.join(state.select("digest", F.col("keep_id").alias("doc_id")), ["digest", "doc_id"], "left_semi").select("digest")
    missing = state.where("keep_id IS NOT NULL AND group_size > 1").join(asked.select("digest"), "digest", "left_semi")
    missing = missing.join(here, "digest", "left_anti").select("digest", "keep_id", "locator")
    paths = [r[0] for r in missing.select("locator").distinct().collect()]  # one of each file
    if not paths:
        return keyed.select("digest", F.col("doc_id").alias("keep_id"), "text").limit(0)
    stored = with_key(spark.read.parquet(*paths), digest).select("digest", F.col("doc_id").alias("keep_id"), "text")
    return stored.join(missing.select("digest", "keep_id"), ["digest", "keep_id"], "left_semi").distinct()


def exact_duplicates(
    docs: DataFrame,
    stream: DataFrame | None = None,
    checkpoint: str | None = None,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``.

    ``stream`` has the same rows as ``docs``; without it, ``docs`` is written to the shared folder
    and streamed from there. Of equal texts the row with the largest doc_id stays. A null text
    counts as empty. Rows that repeat a doc_id and its text are one group and are all marked kept
    if theirs is the largest id; a null doc_id sorts lowest and stays only where no other row has
    its text. No rows give no rows. Other columns are not read. Texts of any length are compared whole, as Spark's strings.

    With a ``checkpoint`` of earlier runs, ``docs`` are the new rows; a text that an earlier row has already goes to the group of
    that entry's keeper, whose file must still be there. Where a digest turns out to stand for several texts, the group's
    size counts the rows of this run and the keeper.
    """
    spark = docs.sparkSession
    folder = run_folder(spark)
    if stream is None:
        path = f"{folder}/input"
        docs.select("doc_id", F.col("text").cast("string").alias("text")).write.parquet(path)
        docs, stream = spark.read.parquet(path), open_stream(spark, path)
    state = written(update_state(stream, checkpoint or f"{folder}/state", digest), "groups", folder)
    keyed = with_key(docs, digest)
    repeated = state.where("group_size > 1").select("digest", "keep_id", "group_size")
    found = written(
        keyed.select("doc_id", "digest", F.sha2("text", 256).alias("text_sha256")).join(
            state.select("digest", "keep_id", "group_size"), "digest"
        ),
        "found",
        folder,
    )
    # Full bytes of every row that hit an entry, and of keepers of earlier runs: an entry is one text if its least and
    # its greatest text are equal. They are found before the shuffle, so copies of a text are one row of each task.
    hits = keyed.join(repeated, "digest")
    earlier = written(earlier_keepers(spark, state, keyed, digest), "earlier", folder)
    texts = hits.select("digest", "text").unionByName(earlier.select("digest", "text"))
    differing = texts.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    differing = written(differing.where("least != greatest").select("digest"), "differing", folder)
    split = hits.select("doc_id", "digest", "text").join(differing, "digest", "left_semi")
    known = split.unionByName(earlier.select(F.col("keep_id").alias("doc_id"), "digest", "text"))
    by_text = written(
        known.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "by-text", folder
    )
    apart = split.join(by_text, ["digest", "text"]).select(
        "doc_id", "digest", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    whole = found.join(differing, "digest", "left_anti").select(apart.columns)
    return whole.unionByName(apart).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
