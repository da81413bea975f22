"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: Sequence[str], order, keep: int = 1) -> DataFrame:
    """The first ``keep`` rows of every group.

    ``row_number() <= keep`` lets Catalyst put a partial group limit before the
    shuffle, so a hot group sends at most ``keep`` rows per map task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= keep).drop("_rank")


def latest_per_key(df: DataFrame, key: str | Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, whose last column should break ties."""
    group = [key] if isinstance(key, str) else list(key)
    return first_per_group(df, group, [F.col(c).desc_nulls_last() for c in newest_by])
