"""Quality rules as a ledger of failure bits.

Each rule is evaluated once per document; the ledger keeps the measurements and, in one long, a bit
for every rule the document fails. Policies are versioned masks over those bits: applying a policy,
or asking what a rule costs, never looks at a text again.

Everything is built-in SQL functions over one row; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.base import SPACES, texts

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rules in the order of their bits: a document fails where the condition holds. A condition uses
#: whole numbers only, so that it is exact.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 50 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("few_distinct_words", "100 * n_distinct_words < 5 * n_words"),
    ("shouting", "100 * n_upper > 70 * word_chars"),
)
BASE_RULES = ("few_words", "repeated_windows")


def bit(name: str) -> int:
    return 1 << [rule for rule, _ in RULES].index(name)


@dataclass(frozen=True)
class Policy:
    """A document is kept if it fails none of these rules."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(name) for name in self.rules)


POLICIES = (
    Policy(1, BASE_RULES),
    Policy(2, tuple(name for name, _ in RULES)),
)
CURRENT = POLICIES[-1]


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measured(docs: DataFrame) -> DataFrame:
    """The measurements of every text, all long."""
    # One separator for all, so that words can be cut at a constant.
    spaced = F.translate(F.col("text"), SPACES[1:], " " * (len(SPACES) - 1))
    words = F.array_remove(F.split(spaced, " "), "")
    lines = F.filter(F.split(F.col("text"), "\n"), lambda line: F.length(without(line, SPACES)) > 0)
    rows = (
        texts(docs)
        .withColumn("words", words)
        .withColumn("lines", lines)
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("windows", F.expr(
            f"CASE WHEN n_words < {WINDOW} THEN array() ELSE transform(sequence(1, int(n_words) - {WINDOW - 1}),"
            f" i -> xxhash64(slice(hashes, i, {WINDOW}))) END"
        ))
        .withColumn("distinct_windows", F.size(F.array_distinct("windows")))
    )
    packed = without(F.col("text"), SPACES)
    return rows.select(
        "doc_id",
        "n_words",
        F.length(packed).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct_words"),
        (F.length(packed) - F.length(F.regexp_replace(packed, r"\p{Lu}", ""))).cast("long").alias("n_upper"),
        F.when(F.col("distinct_windows") == F.size("windows"), F.lit(0).cast("long"))
        .otherwise(repeated_words(F.col("windows")))
        .alias("n_repeat_words"),
    )


def repeated_words(windows: Column) -> Column:
    """How many words lie in windows that occur twice or more.

    Sorted pairs of hash and place bring equal windows together; a window is repeated if a
    neighbour has its hash. The repeated places, in order, cover their words like intervals of
    equal length: each adds what its predecessor has not covered.
    """
    pairs = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    marked = F.transform(
        F.arrays_zip(
            pairs.alias("at"),
            F.concat(F.array(F.lit(None)), F.slice(pairs, 1, F.size(pairs) - 1)).alias("before"),
            F.concat(F.slice(pairs, 2, F.size(pairs)), F.array(F.lit(None))).alias("after"),
        ),
        lambda p: F.when(
            F.coalesce(p["at"]["w"] == p["before"]["w"], F.lit(False))
            | F.coalesce(p["at"]["w"] == p["after"]["w"], F.lit(False)),
            p["at"]["i"],
        ),
    )
    places = F.array_sort(F.array_compact(marked))
    gaps = F.zip_with(
        F.slice(places, 2, F.size(places)),
        F.slice(places, 1, F.size(places) - 1),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)),
    )
    return F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda total, gap: total + gap)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit i set where rule i fails.

    A null or empty text has no words: its measurements are 0 and only ``few_words`` fails, since
    the other conditions are strict. Repeated rows give repeated rows, no rows give none, and
    other columns are not read.
    """
    failed = F.lit(0).cast("long")
    for name, condition in RULES:
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(bit(name))).otherwise(0).cast("long"))
    return measured(docs).withColumn("failed", failed)


def apply_policy(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Adds ``kept`` under the policy."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of the policy: rows that fail it, and rows that fail it alone, which are those
    that would stay without it. Bit patterns are counted first: at most one row per pattern."""
    patterns = (
        entries.select(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits"))
        .groupBy("bits")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).alias("bit")) for r in policy.rules])
    return (
        patterns.select("bits", "rows", F.inline(rules))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("rows")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("rows")).otherwise(0)).alias("failing_alone"),
        )
        .withColumn("policy", F.lit(policy.version))
    )
