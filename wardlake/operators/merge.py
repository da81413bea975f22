"""Applying change rows to a current-state table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OP = "cdc_op"
DELETE = "d"


def change_op(columns: list[str], op: str = "__op", deleted: str = "__deleted"):
    """The operation of a change: the envelope's code, else its delete mark, else create."""
    choices = []
    if op in columns:
        choices.append(F.col(op))
    if deleted in columns:
        choices.append(F.when(F.col(deleted) == "true", F.lit(DELETE)))
    return F.coalesce(*choices, F.lit("c"))


def live_rows(df: DataFrame, op: str = OP) -> DataFrame:
    """Rows that are not delete markers; an unknown operation is no row either."""
    return df.filter(F.col(op) != DELETE)


def merge_changes(target: DataFrame | None, source: DataFrame, key: str, op: str = OP) -> DataFrame:
    """The target after the three MERGE clauses: matched deletes, matched updates, and
    inserts of unmatched non-deletes.

    ``source`` holds one row per key. A source row with a NULL operation satisfies no
    clause, so it changes nothing. A NULL key matches nothing: such target rows stay and
    such source rows are inserted. They pass beside the join, which keeps a large set of
    NULL keys out of one shuffle partition (the NULL scan is pushed to row-group
    statistics). Without a target the table is created from the non-deletes.
    """
    inserts = live_rows(source, op)
    if target is None:
        return inserts
    acting = source.filter(F.col(op).isNotNull()).select(key)
    kept = target.filter(F.col(key).isNotNull()).join(acting, key, "left_anti")
    keyless = target.filter(F.col(key).isNull())
    return kept.unionByName(keyless).unionByName(inserts)


def merge_into(source: DataFrame, table: str, key: str, op: str = OP) -> None:
    """The same clauses on a catalog table whose format has row-level operations, where
    the format itself finds and rewrites the files concerned. Plain parquet has none."""
    acts = F.col(f"s.{op}")
    (
        source.alias("s")
        .mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
        .whenMatched(acts == DELETE).delete()
        .whenMatched(acts != DELETE).updateAll()
        .whenNotMatched(acts != DELETE).insertAll()
        .merge()
    )
