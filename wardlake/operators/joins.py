"""Joins of a many-rows-per-key side with a one-row-per-key side."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_unique(many: DataFrame, unique: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``many`` to ``unique`` (one row per ``key``).

    One plan at every size: a shuffled join, or a broadcast one where Spark measures the unique
    side as small. A key with a large part of all rows, and the rows without a key, which meet in
    one partition too, are split by adaptive execution, which copies the one matching row to each
    part (``spark.sql.adaptive.skewJoin``, on in every session of ``build_session``).
    """
    return many.join(unique, key, how)
