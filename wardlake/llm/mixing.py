"""Mixing of sources to target weights by pivotal rounding.

A source whose target is ``r`` times its size takes every document ``floor(r)`` times and some of them once
more. How much of the further copy a document still owes is its *mass*, at first the fraction of ``r``
times its size, in words.

Two documents of a source that owe part of a copy pass mass from one to the other until one of them
owes nothing or a whole copy and is settled: of the two ways to get there one is drawn, the likelier
the shorter it is, so that every document keeps its expected mass, and the sum of both never
changes. The other goes on to the next pair. Blocks of about ``BLOCK`` documents are folded so, each to
a single document that is not settled; those make the blocks of the next level, up to one for each
source. That one takes the nearer of nothing and a whole copy: a source misses its target by
no more than half a document.

All is DataFrame functions. Blocks and draws follow from hashes of what a row is, not of where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.base import WORD, numbered, written
from wardlake.session import run_folder

# The weights of sources in order, the words to take for every two, and the most that a source gives.
WEIGHTS = (3, 1, 2)
SHARE_NUMERATOR, SHARE_DENOMINATOR = 3, 2
MOST_COPIES = 2
#: Documents of a block, on average.
BLOCK = 32
#: Copies of a row that are told apart in one step.
COPIES_PER_STEP = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text; a null text has none)."""
    words = F.regexp_count(F.col("text").cast("string"), F.lit(WORD))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
    )


def rows_told_apart(sized: DataFrame) -> DataFrame:
    """One row for each row of ``sized``, equal ones numbered by ``copy``. Equal rows are counted before the
    shuffle, so a row that comes very often is one row of it from each task."""
    counted = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_PER_STEP}")))
    steps = counted.withColumn("step", step).withColumn("from", F.col("step") * COPIES_PER_STEP)
    to = F.least(F.col("n"), F.col("from") + COPIES_PER_STEP) - 1
    return steps.withColumn("copy", F.explode(F.sequence(F.col("from"), to))).select("doc_id", "source", "size", "copy")


def targets(units: DataFrame) -> DataFrame:
    """source, source_size, n (documents with words), weight, target (double) of every source.

    Sources are in the order of their code points, null last. Their targets are in proportion to their
    weights; what a source would get beyond ``MOST_COPIES`` times its size is shared among the others again,
    until none is above. Each round of sharing adds up the sources once.
    """
    found = units.groupBy("source").agg(
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"), F.count_if(F.col("size") > 0).alias("n")
    )
    ordered = numbered(found, F.col("source").asc_nulls_last(), name="rank")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighted = ordered.withColumn("weight", F.get(weights, F.pmod("rank", F.lit(len(WEIGHTS))).cast("int")).cast("long"))
    weighted = written(weighted.withColumn("most", MOST_COPIES * F.col("source_size")), "sources")
    words = (weighted.agg(F.sum("source_size")).first()[0] or 0) * SHARE_NUMERATOR
    # A source gets ``left / weights`` for each unit of weight, in ``SHARE_DENOMINATOR``-ths of a word.
    def exact(number: Column | str) -> Column:
        return (F.col(number) if isinstance(number, str) else number).cast("decimal(19,0)")

    left, of_weights = words, weighted.agg(F.sum("weight")).first()[0] or 1
    while True:
        above = exact("most") * exact(F.lit(SHARE_DENOMINATOR * of_weights)) < exact("weight") * exact(F.lit(left))
        capped = weighted.where(above).agg(F.sum("most"), F.sum("weight"), F.count(F.lit(1))).first()
        free = weighted.where(~above).agg(F.sum("weight")).first()[0]
        next_left = words - (capped[0] or 0) * SHARE_DENOMINATOR
        if (next_left, free) == (left, of_weights) or not free:
            break
        left, of_weights = next_left, free
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(SHARE_DENOMINATOR * of_weights))
    return weighted.withColumn("target", F.when(above, F.col("most").cast("double")).otherwise(share)).drop("most")


def uniform(*of: Column | str) -> Column:
    """A number from 0 to below 1, drawn by a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def fold(units: Column, level: int) -> Column:
    """Struct of ``open``, the one of ``units`` that is not settled (null if all are), and ``settled``, the others,
    each with its ``mass`` at 0 or its size. ``units`` are structs of key, doc_id, copy, size and mass."""
    one = "struct<key:bigint,doc_id:bigint,copy:bigint,size:bigint,mass:double>"
    start = F.struct(F.lit(None).cast(one).alias("open"), F.array().cast(f"array<{one}>").alias("settled"))

    def with_mass(unit: Column, mass: Column) -> Column:
        return F.struct(*[unit[c].alias(c) for c in ("key", "doc_id", "copy", "size")], mass.alias("mass")).cast(one)

    def step(state: Column, unit: Column) -> Column:
        held = state["open"]
        a, x, b, y = held["size"].cast("double"), held["mass"], unit["size"].cast("double"), unit["mass"]
        # Up: the held one takes until it is full or the other has none left. Down: the other way round.
        up, down = F.least(a - x, y), F.least(x, b - y)
        goes_up = uniform(held["key"], unit["key"], F.lit(level)) * (up + down) < down
        held_settles = F.when(goes_up, a - x <= y).otherwise(x <= b - y)
        held_mass = F.when(goes_up, F.when(a - x <= y, a).otherwise(x + y)).otherwise(
            F.when(x <= b - y, F.lit(0.0)).otherwise(x - (b - y))
        )
        unit_mass = F.when(goes_up, F.when(a - x <= y, y - (a - x)).otherwise(F.lit(0.0))).otherwise(
            F.when(x <= b - y, x + y).otherwise(b)
        )
        held_after, unit_after = with_mass(held, held_mass), with_mass(unit, unit_mass)
        settled = F.when(held_settles, held_after).otherwise(unit_after)
        left = F.when(held_settles, unit_after).otherwise(held_after)
        # Both may be settled at once.
        both = (left["mass"] <= 0) | (left["mass"] >= left["size"])
        return F.struct(
            F.when(~both, left).alias("open"),
            F.concat(state["settled"], F.when(both, F.array(settled, left)).otherwise(F.array(settled))).alias("settled"),
        )

    def merge(state: Column, unit: Column) -> Column:
        first = F.struct(with_mass(unit, unit["mass"]).alias("open"), state["settled"].alias("settled"))
        kind = f"struct<open:{one},settled:array<{one}>>"
        return F.when(state["open"].isNull(), first.cast(kind)).otherwise(step(state, unit).cast(kind)).cast(kind)

    return F.aggregate(units, start, merge)


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source: one row for each row of ``docs``.

    ``docs`` has doc_id, text and source; other columns are not read. A null text has no words, and is taken
    as often as its source's whole copies; null sources are one source; rows without an id or with equal ids are
    documents like others, and equal rows are told apart by number. A source without words has the target 0. Texts
    of any length are one count. No rows give none. ``taken`` is ``copies`` times ``size``.
    """
    folder = run_folder(docs.sparkSession)
    units = written(rows_told_apart(sizes(docs)), "units", folder)
    sources = written(targets(units), "targets", folder)
    ratio = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor("ratio").cast("long")
    names = sources.select(F.col("source").alias("_of"), "rank", "source_size", "target", F.col("n").alias("members")).withColumn(
        "ratio", ratio
    )
    owing = units.join(names, F.col("source").eqNullSafe(F.col("_of"))).withColumn(
        "mass", (F.col("ratio") - whole) * F.col("size")
    )
    settled = F.expr("mass <= 0 or mass >= size")
    columns = ["rank", "doc_id", "copy", "size", "mass"]
    done = [owing.where(settled).select(*columns)]
    key = F.xxhash64("rank", "doc_id", F.col("doc_id").isNull(), "size", "copy")
    rows = owing.where(~settled).select(key.alias("key"), *columns, "members")
    most, level = sources.agg(F.max("n")).first()[0] or 0, 0
    while most > 0:
        blocks = F.ceil(F.col("members") / block)
        unit = F.struct("key", "doc_id", "copy", "size", "mass")
        folded = (
            rows.withColumn("members", blocks)
            .withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.col("members")))
            .groupBy("rank", "members", "block")
            .agg(F.array_sort(F.collect_list(unit)).alias("units"))
            .select("rank", "members", fold(F.col("units"), level).alias("f"))
        )
        folded = written(folded, f"level-{level}", folder)
        done.append(folded.select("rank", F.explode("f.settled").alias("u")).select("rank", "u.doc_id", "u.copy", "u.size", "u.mass"))
        rows = folded.where("f.open is not null").select("rank", "members", "f.open.*")
        most, level = (0, level) if most <= block else (-(-most // block), level + 1)
    done.append(rows.select("rank", "doc_id", "copy", "size", F.expr("if(2 * mass >= size, size, 0)").cast("double").alias("mass")))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    of_source = names.select(F.col("rank").alias("_rank"), "ratio", "source_size", "target", F.col("_of").alias("source"))
    copies = whole + F.expr("if(size > 0 and mass >= size, 1, 0)")
    return (
        every.join(of_source, F.col("rank") == F.col("_rank"))
        .withColumn("copies", copies.cast("long"))
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")
    )


def mixed_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, whose ids are unique, as often as ``mixed`` takes them."""
    often = mixed.where("copies > 0").select(F.col("doc_id").alias("_id"), F.expr("explode(sequence(1, copies))").alias("copy"))
    return docs.join(often, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
