"""Substring search through posting lists of trigrams.

A *block* is ``1 << BLOCK_BITS`` neighbouring ids. The index has one row for each trigram and block: the ids of the block whose
lower-cased text holds the trigram. However common a trigram is, a list is no longer than a block, and a search for a
keyword meets, block by block, as many lists as the keyword has trigrams. Rows lie in folders by a hash of the trigram
and in files sorted by it, so a search opens the folders of its trigrams and skips row groups of others.

A text that holds the keyword holds all its trigrams; the reverse is not so, hence what the lists have in common is
checked against the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.splits import SplitTable

GRAM = 3
BLOCK_BITS = 15
SHARDS = 256
#: A task that writes the index sorts the rows of some shards and blocks: this many bytes of text lead to one task.
TEXT_BYTES = 32 << 20
POSTINGS = "gram string, block long, ids array<long>, shard int"


def grams(text: Column) -> Column:
    """The distinct trigrams of a text, empty for shorter ones and for null. Characters are taken once each, so the
    time is in proportion to the text."""


    def of(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - GRAM + 1)
        return F.transform(starts, lambda at: F.concat(*[F.element_at(chars, (at + i).cast("int")) for i in range(GRAM)]))

    # Bound to a lambda's name, the characters are parted once and not for every trigram.
    parted = F.flatten(F.transform(F.array(F.split(text, "")), of))
    return F.when(F.length(text) >= GRAM, F.array_distinct(parted)).otherwise(F.array().cast("array<string>"))


def shard_of(gram: Column | str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SHARDS)).cast("int")


def block_of(key: Column | str) -> Column:
    return F.shiftright(F.col(key).cast("long") if isinstance(key, str) else key, BLOCK_BITS)


def postings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """gram, block, ids (ascending), shard. Rows without a key or a text have none."""
    found = rows.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.explode(grams(F.lower(text))).alias("gram")
    )
    lists = found.groupBy("gram", block_of("id").alias("block")).agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return lists.withColumn("shard", shard_of("gram"))


class TextIndex:
    """Rows by a unique integer key, and the posting lists of one of their text columns."""

    def __init__(self, spark: SparkSession, root: str, key: str, text: str):
        self.spark, self.root, self.key, self.text = spark, root.rstrip("/"), key, text
        self.rows = SplitTable(spark, f"{self.root}/rows", key)

    def build(self, rows: DataFrame) -> None:
        """Store the rows and the lists of all. Keys are unique and not null."""
        self.rows.merge(rows.withColumn(self.key, F.col(self.key).cast("long")), start_anew=True)
        stored = self.rows.read()
        size = stored.agg(F.sum(F.octet_length(self.text))).first()[0] or 0
        tasks = max(1, -(-size // TEXT_BYTES))
        (
            postings(stored, self.key, self.text)
            .repartition(tasks, "shard", F.pmod("block", F.lit(max(1, tasks // SHARDS))))
            .sortWithinPartitions("shard", "gram", "block")
            .write.mode("overwrite")
            .partitionBy("shard")
            .parquet(f"{self.root}/postings")
        )

    def lists(self, wanted: list[str]) -> DataFrame:
        """The posting lists of some trigrams: folders and row groups of others are not read."""
        stored = self.spark.read.schema(POSTINGS).parquet(f"{self.root}/postings")
        found = self.spark.createDataFrame([(g,) for g in wanted], "gram string").select(shard_of("gram")).distinct()
        return stored.where(F.col("shard").isin([r[0] for r in found.collect()]) & F.col("gram").isin(wanted))

    def candidates(self, keyword: str) -> DataFrame | None:
        """The keys of all rows that hold every trigram of the keyword; None if it has no trigram."""
        given = self.spark.createDataFrame([(keyword,)], "k string").select(grams(F.lower("k"))).first()[0]
        if not given:
            return None
        # A block gives at most one list per trigram of the keyword, none longer than a block.
        met = self.lists(given).groupBy("block").agg(F.collect_list("ids").alias("all")).where(F.size("all") == len(given))
        common = F.reduce("all", F.element_at("all", 1), lambda a, b: F.array_intersect(a, b))
        return met.select(F.explode(common).alias(self.key))

    def search(self, keyword: str) -> DataFrame:
        """The rows whose text holds the keyword in any case. Keywords of fewer than three characters are looked for in
        every text, others in the texts that the lists name, of which only the splits are opened."""
        keys = self.candidates(keyword)
        rows = self.rows.read() if keys is None else self.rows.read_for(keys).join(keys, self.key, "left_semi")
        return rows.where(F.contains(F.lower(self.text), F.lower(F.lit(keyword))))
