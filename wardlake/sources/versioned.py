"""Parquet tables published whole, as commits.

A job must not overwrite the files it is reading, and a reader must not see half a
write. So every write goes to a new directory ``commit=<n>`` below the table, which
counts once Spark has put its ``_SUCCESS`` file there. One writer per table at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_COMMIT = re.compile(r"commit=(\d{10})(?:\.(.+))?$")


class CommittedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def listed(self, path: str) -> list[str]:
        """Names in a folder, none if it isn't there."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(folder))

    def holds(self, name: str) -> bool:
        return name in self.listed(self.root)

    def names(self) -> list[str]:
        """Names of all commits, those that failed too, oldest first."""
        return [name for name in self.listed(self.root) if _COMMIT.match(name)]

    @staticmethod
    def number_of(name: str) -> int:
        return int(_COMMIT.match(name).group(1))

    @staticmethod
    def txn_of(name: str) -> str | None:
        return _COMMIT.match(name).group(2)

    def next_name(self, txn: str | None) -> str:
        names = self.names()
        number = self.number_of(names[-1]) + 1 if names else 0
        return f"commit={number:010d}" + (f".{txn}" if txn else "")

    def delete(self, path: str) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def _finished(self) -> dict[str, list[str]]:
        """Finished commits, oldest first, with the names they contain."""
        contents = {name: self.listed(f"{self.root}/{name}") for name in self.names()}
        return {name: inside for name, inside in contents.items() if "_SUCCESS" in inside}

    def commits(self) -> list[str]:
        """Names of the finished commits, oldest first."""
        return list(self._finished())

    def has(self, txn: str) -> bool:
        return any(self.txn_of(name) == txn for name in self.commits())

    def publish(self, df: DataFrame, txn: str | None = None) -> bool:
        """Write ``df`` as the next commit. A transaction already there is not repeated."""
        if txn is not None and self.has(txn):
            return False
        df.write.mode("errorifexists").parquet(f"{self.root}/{self.next_name(txn)}")
        return True

    def read(self) -> DataFrame | None:
        """The newest commit, or None before the first one."""
        commits = self.commits()
        return self.spark.read.parquet(f"{self.root}/{commits[-1]}") if commits else None

    def read_commit(self, name: str) -> DataFrame:
        """A commit by its name."""
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop_superseded(self, keep: int = 2) -> list[str]:
        """Delete old commits, sparing the last one and the last ``keep``, and remains of writes that failed
        before them."""
        commits = self.commits()
        spared = set(commits[-1:]) | set(commits[len(commits) - keep :] if keep else [])
        last = commits[-1] if commits else ""
        stale = [name for name in self.names() if name < last and name not in spared]
        for name in stale:
            self.delete(f"{self.root}/{name}")
        return stale
