"""Keyed Parquet tables that are changed by writing only what changes.

Rows are kept in *splits*, ranges of the key that together hold every key. A split has a few files; its size is
measured, and one that outgrows ``split_bytes`` is cut at quantiles of its keys. A commit holds

- ``data``: the new rows, one file for each split that they fall into,
- ``marks``: bitmaps of the places of the rows that they replace, in files of earlier commits,
- ``feed``: the old and the new image of every changed row, for whoever follows the table,
- ``manifest``: every file that is current, with its split, rows, bytes, least and greatest key, and the commits
  that mark rows in it.

The manifest is written last, and the commit counts once it is there. A reader takes the newest manifest
and nothing else: it lists no commit, and of a range of keys it opens only the files whose keys may lie in it. Files
without marks are read as they are. A split that has too many files, too many marked rows or too many
bytes is folded into new files by the commit that finds it so. One writer per table at a time.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.operators.dedupe import latest_per_key
from wardlake.operators.merge import DELETE
from wardlake.sources.versioned import CommittedTable

SPLIT_BYTES = 128 << 20
#: Files of a split before it is folded, and the share of marked rows at which it is.
MOST_FILES = 8
MOST_MARKED = 0.25
#: A first commit joins neighbouring files up to this part of a split's bytes.
LEAST_SPLIT = 8
#: A key is hot if it fills more than one of so many equal shares of a table's rows, in tables of so many rows.
HOT_SHARES, LEAST_HOT = 64, 1 << 20
SPLIT, FILE, ROW = "_split", "_file", "_row"
_MANIFEST = (
    "split long, low long, high long, path string, rows long, bytes long, least long, greatest long, marked long,"
    " marks array<string>, about string"
)


@dataclass(frozen=True)
class File:
    """A file of a split; a split without files has one entry without a path."""

    split: int
    low: int | None
    high: int | None
    path: str | None = None
    rows: int = 0
    bytes: int = 0
    least: int | None = None
    greatest: int | None = None
    marked: int = 0
    marks: tuple[str, ...] = ()


def newer(newest_by: Iterable[str]) -> Callable[[Column, Column], Column]:
    """A change acts if its version is greater than that of the row it meets."""
    names = list(newest_by)
    return lambda new, old: F.struct(*[new[n] for n in names]) > F.struct(*[old[n] for n in names])


class SplitTable:
    def __init__(
        self, spark: SparkSession, root: str, key: str | None = None,
        split_bytes: int = SPLIT_BYTES, most_files: int = MOST_FILES,
    ):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.split_bytes, self.most_files = split_bytes, most_files
        self.folder = CommittedTable(spark, root)

    # Commits -----------------------------------------------------------------------
    def _names(self) -> list[str]:
        return self.folder.names()

    def _finished(self, name: str) -> bool:
        return "_SUCCESS" in self.folder.listed(f"{self.root}/{name}/manifest")

    def newest(self) -> str | None:
        """Name of the newest finished commit."""
        return next((name for name in reversed(self._names()) if self._finished(name)), None)

    def number(self) -> int:
        """Number of the newest finished commit, -1 before the first."""
        name = self.newest()
        return -1 if name is None else self.folder.number_of(name)

    def has(self, txn: str) -> bool:
        return any(self._finished(name) for name in self._names() if self.folder.txn_of(name) == txn)

    def manifest(self) -> tuple[list[File], dict]:
        """Current files, and what the last commit says about the table (schema, and a stamp if it set one)."""
        name = self.newest()
        if name is None:
            return [], {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/{name}/manifest").collect()
        files = [File(**{k: tuple(v) if k == "marks" else v for k, v in r.asDict().items() if k != "about"}) for r in rows]
        return files, json.loads(rows[0]["about"])

    # Reading -----------------------------------------------------------------------
    def read(self) -> DataFrame | None:
        """All rows, or None before the first commit."""
        files, about = self.manifest()
        return self._with_stamp(self._rows(files, about), about) if about else None

    def read_between(self, ranges: Iterable[tuple[int, int]]) -> DataFrame | None:
        """The rows with a key in one of the ranges (first and last key), from files that may have such."""
        files, about = self.manifest()
        ranges = list(ranges)
        chosen = [f for f in files if f.path and any(f.least <= b and a <= f.greatest for a, b in ranges)]
        if not about:
            return None
        inside = F.lit(False)
        for a, b in _joined(ranges):
            inside = inside | F.col(self.key).between(a, b)
        return self._with_stamp(self._rows(chosen, about).where(inside), about)

    def read_for(self, keys: DataFrame) -> DataFrame | None:
        """The rows whose keys are among ``keys``, from the splits that hold them."""
        files, about = self.manifest()
        if not about:
            return None
        wanted = keys.select(F.col(keys.columns[0]).cast("long").alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        held = {r[0] for r in self._located(wanted, files).select(SPLIT).distinct().collect()}
        rows = self._rows([f for f in files if f.split in held], about)
        return self._with_stamp(rows.join(wanted, self.key, "left_semi"), about)

    def feed(self, after: int) -> DataFrame | None:
        """Old and new images of all commits after number ``after``, with ``commit``; None if some are gone."""
        _, about = self.manifest()
        later = {self.folder.number_of(n): n for n in self._names() if self.folder.number_of(n) > after}
        if not about or after < about.get("anew", 0) or set(later) < set(range(after + 1, self.number() + 1)):
            return None
        images = f"new {_ddl(about)}, old {_ddl(about)}"
        rows = self.spark.createDataFrame([], f"commit int, {images}")
        for number, name in later.items():
            if self._finished(name):
                one = self.spark.read.schema(images).parquet(f"{self.root}/{name}/feed")
                rows = rows.unionByName(one.withColumn("commit", F.lit(number)))
        return rows

    def _with_stamp(self, rows: DataFrame, about: dict) -> DataFrame:
        for name, micros in about.get("stamp", {}).items():
            rows = rows.withColumn(name, F.timestamp_micros(F.lit(micros)))
        return rows

    def _rows(self, files: list[File], about: dict, places: bool = False) -> DataFrame:
        """Live rows of ``files``; with ``places``, also where each lies. Columns that an older file lacks are NULL."""
        schema = StructType.fromJson(about["schema"])
        columns = [F.col(f"`{n}`") for n in schema.names]
        found = []
        for marked in (False, True):
            chosen = [f for f in files if f.path and bool(f.marked) == marked]
            if not chosen:
                continue
            rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{f.path}" for f in chosen])
            if places or marked:
                rows = rows.select(*columns, _file().alias(FILE), F.col("_metadata.row_index").alias(ROW))
            if marked:
                rows = self._unmarked(rows, sorted({m for f in chosen for m in f.marks}))
            found.append(rows if places else rows.select(*columns))
        if not found:
            more = [F.lit(None).cast("string").alias(FILE), F.lit(None).cast("long").alias(ROW)] if places else []
            return self.spark.createDataFrame([], schema).select(*columns, *more)
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def _unmarked(self, rows: DataFrame, commits: list[str]) -> DataFrame:
        """Without the rows that the bitmaps of ``commits`` mark."""
        marks = self.spark.read.parquet(*[f"{self.root}/{c}/marks" for c in commits])
        marks = marks.groupBy(F.col("file").alias("_marked"), "window").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        # The bitmap functions count from 1.
        joined = rows.join(marks, (F.col(FILE) == F.col("_marked")) & (F.expr(f"bitmap_bucket_number({ROW} + 1)") == F.col("window")), "left")
        bit = F.expr(f"bitmap_bit_position({ROW} + 1)")
        byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_marked = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
        return joined.where(~is_marked).drop("_marked", "window", "bits")

    # Writing -----------------------------------------------------------------------
    def merge(
        self,
        changes: DataFrame,
        txn: str | None = None,
        newest_by: list[str] | None = None,
        op: str | None = None,
        keep_op: bool = True,
        stamp: dict[str, dt.datetime] | None = None,
        start_anew: bool = False,
        ranged: bool = False,
    ) -> bool:
        """Bring the table to ``changes``, which have a key each; rows without one are left out.

        With ``newest_by`` the newest change of a key acts, and only if it is newer than the row it meets; every
        row stays, delete markers too, so that late changes revive nothing. Otherwise keys do not repeat,
        and every change acts; if ``op`` names a column (kept, or not: ``keep_op``), a delete removes the row that it
        meets, and a NULL operation does nothing. A transaction that is already there is not repeated. ``stamp`` is a time column that
        all rows show until the next commit. ``start_anew`` forgets the rows so far. ``ranged`` says that the changes
        are dealt out by ranges of the key already (``ranges_for_first``).
        """
        if txn is not None and self.has(txn):
            return False
        files, about = ([], {}) if start_anew else self.manifest()
        home = self._new_commit(txn)
        rows = changes.where(F.col(self.key).isNotNull())
        if newest_by:
            rows = latest_per_key(rows, self.key, newest_by)
        if op:
            rows = rows.where(F.col(op).isNotNull())
        columns = StructType([f for f in rows.schema.fields if keep_op or f.name != op])
        told = {"schema": json.loads(_widened(about, columns).json())}
        anew = int(home.rsplit("commit=", 1)[1][:10])
        if not files:
            # Nothing to meet: the changes are the table, and nobody has followed it so far.
            if op:
                rows = rows.where(F.col(op) != DELETE)
            self._lay_out(home, rows.select(*[F.col(f"`{n}`") for n in columns.names]), told | {"anew": anew}, ranged, stamp)
            return True
        about = told | {"anew": about.get("anew", 0)}
        # Written once: the changes are counted, located and joined, and their bytes measured.
        rows.write.parquet(f"{home}/incoming")
        incoming = self.spark.read.schema(rows.schema).parquet(f"{home}/incoming")
        measured = incoming.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
        located = self._located(incoming, files)
        sizes = located.groupBy(SPLIT).agg(F.count(F.lit(1)), F.min(self.key), F.max(self.key)).collect()
        touched = {r[0]: (r[1], r[2], r[3]) for r in sizes}
        row_bytes = measured / max(1, sum(n for n, _, _ in touched.values()))
        may_meet = [f for f in files if f.path and f.split in touched and f.least <= touched[f.split][2] and touched[f.split][1] <= f.greatest]
        feed = self._feed(located, self._rows(may_meet, about, places=True), about, newest_by, op, f"{home}/feed")
        met = {r[0]: (r[1], r[2]) for r in feed.groupBy(SPLIT).agg(F.count("new"), F.count("old")).collect()}
        fold = self._to_fold(files, met, row_bytes)
        self._publish(home, files, about, *_sides(feed), met, row_bytes, fold, stamp)
        self.folder.delete(f"{home}/incoming")
        return True

    def ranges_for_first(self, rows: DataFrame) -> DataFrame | None:
        """``rows`` dealt out by ranges of the key, if the table has no commit so far: versions meet and files are laid out in one
        shuffle. None if it has one, or if a key holds so many rows that a range of it alone would be too large for a task."""
        if self.newest() is not None:
            return None
        key = F.col(self.key)
        shares = [i / HOT_SHARES for i in range(1, HOT_SHARES)]
        cuts = rows.agg(F.percentile_approx(key, shares, 100 * HOT_SHARES), F.count(key)).first()
        if cuts[1] >= LEAST_HOT and len(set(cuts[0])) < len(cuts[0]):
            return None
        return rows.where(key.isNotNull()).repartitionByRange(self.key)

    def _lay_out(self, home: str, rows: DataFrame, about: dict, ranged: bool, stamp) -> None:
        """The first commit: rows are dealt out by ranges of the key and written once; neighbouring files make up a split."""
        dealt = rows if ranged else rows.repartitionByRange(self.key)
        dealt.sortWithinPartitions(self.key).write.parquet(f"{home}/data/whole")
        found = self._files(f"{home}/data/whole")
        if any(f.bytes > self.split_bytes for f in found):
            parts = 2 * -(-sum(f.bytes for f in found) // self.split_bytes)
            again = self.spark.read.schema(rows.schema).parquet(f"{home}/data/whole").repartitionByRange(parts, self.key)
            again.sortWithinPartitions(self.key).write.parquet(f"{home}/data/cut")
            self.folder.delete(f"{home}/data/whole")
            found = self._files(f"{home}/data/cut")
        groups: list[list[File]] = []
        for f in found:
            if groups and sum(g.bytes for g in groups[-1]) + f.bytes <= self.split_bytes // LEAST_SPLIT and len(groups[-1]) < self.most_files // 2:
                groups[-1].append(f)
            else:
                groups.append([f])
        lows = [None, *[g[0].least for g in groups[1:]]]
        current = [replace(f, split=s, low=a, high=b) for s, (g, a, b) in enumerate(zip(groups, lows, [*lows[1:], None], strict=False)) for f in g]
        if stamp:
            about = about | {"stamp": {n: int(at.timestamp() * 1e6) for n, at in stamp.items()}}
        self._write_manifest(home, current or [File(0, None, None)], about)

    def _files(self, path: str) -> list[File]:
        """The files of a folder that have rows, in the order of their keys."""
        rows = self.spark.read.schema(f"`{self.key}` long").parquet(path).groupBy(_file().alias(FILE))
        found = rows.agg(F.count(F.lit(1)), F.max("_metadata.file_size"), F.min(self.key), F.max(self.key)).collect()
        return sorted((File(0, None, None, *r) for r in found), key=lambda f: f.least)

    def fold(self) -> bool:
        """Rewrite every split that has marked rows or more than one file."""
        files, about = self.manifest()
        several = {f.split for f in files if f.marked} | {s for s, n in _count(files).items() if n > 1}
        if not several:
            return False
        home = self._new_commit(None)
        nothing = self._feed(self._rows([], about).withColumn(SPLIT, F.lit(0).cast("long")), self._rows([], about, places=True), about, None, None, f"{home}/feed")
        self._publish(home, files, about, *_sides(nothing), {}, 0.0, several, None)
        return True

    def _new_commit(self, txn: str | None) -> str:
        return f"{self.root}/{self.folder.next_name(txn)}"

    def _feed(self, located: DataFrame, old: DataFrame, about: dict, newest_by, op: str | None, path: str) -> DataFrame:
        """Split, new and old image, and the old one's place, of every change that acts."""
        names = StructType.fromJson(about["schema"]).names
        known = [F.col(f"`{n}`") if n in located.columns else F.lit(None).alias(n) for n in names]
        goes = F.col(op) == DELETE if op else F.lit(False)
        new = located.select(F.col(self.key).alias("_key"), SPLIT, goes.alias("_goes"), F.struct(*known).cast(_ddl(about)).alias("new"))
        image = F.struct(*[F.col(f"`{n}`") for n in names]).cast(_ddl(about)).alias("old")
        met = new.join(old.select(F.col(self.key).alias("_met"), image, FILE, ROW), F.col("_key") == F.col("_met"), "left")
        if newest_by:
            met = met.where(F.col("old").isNull() | newer(newest_by)(F.col("new"), F.col("old")))
        if op:
            met = met.where("NOT _goes OR old IS NOT NULL").withColumn("new", F.expr("if(_goes, NULL, new)"))
        return self._written(met, about, path)

    def _written(self, feed: DataFrame, about: dict, path: str) -> DataFrame:
        feed.select(SPLIT, "new", "old", FILE, ROW).write.parquet(path)
        return self.spark.read.schema(f"{SPLIT} long, new {_ddl(about)}, old {_ddl(about)}, {FILE} string, {ROW} long").parquet(path)

    def _to_fold(self, files: list[File], met: dict, row_bytes: float) -> set[int]:
        chosen, count = set(), _count(files)
        for split, (added, replaced) in met.items():
            own = [f for f in files if f.split == split]
            rows, marked = sum(f.rows for f in own), sum(f.marked for f in own) + replaced
            size = sum(f.bytes for f in own) + added * row_bytes
            if count[split] + 1 > self.most_files or marked > MOST_MARKED * max(1, rows) or size > self.split_bytes:
                chosen.add(split)
        return chosen

    def _publish(
        self, home: str, files: list[File], about: dict, new_rows: DataFrame, gone: DataFrame | None, met: dict,
        row_bytes: float, fold: set[int], stamp,
    ) -> None:
        """Write data, marks and manifest of a commit: ``new_rows`` come, the places ``gone`` go."""
        kept = [f for f in files if f.split not in fold]
        name = home.rsplit("/", 1)[1]
        folds = F.col(SPLIT).isin(*fold) if fold else F.lit(False)
        content, directory = new_rows.where(~folds), kept
        if fold:
            folded = [f for f in files if f.split in fold]
            inside = new_rows.where(folds).drop(SPLIT)
            if gone is not None:
                stay = self._rows(folded, about, places=True).join(gone.select(FILE, ROW), [FILE, ROW], "left_anti").drop(FILE, ROW)
                inside = stay.unionByName(inside)
            cut = self._cut(folded, inside, met, row_bytes, max(f.split for f in files) + 1)
            content = content.unionByName(self._located(inside, cut))
            directory = kept + cut
        content.repartition(SPLIT).sortWithinPartitions(SPLIT, self.key).write.partitionBy(SPLIT).parquet(f"{home}/data")
        replaced = {} if gone is None else self._mark(home, gone.where(~folds))
        kept = [
            replace(f, marked=f.marked + replaced[f.path], marks=(*f.marks, name)) if replaced.get(f.path) else f for f in kept
        ]
        ranges = {f.split: (f.low, f.high) for f in directory}
        current = [f for f in kept if f.path] + self._measured(home, ranges)
        current += [File(s, *bounds) for s, bounds in ranges.items() if s not in {f.split for f in current}]
        if stamp:
            about = about | {"stamp": {n: int(at.timestamp() * 1e6) for n, at in stamp.items()}}
        self._write_manifest(home, current, about)

    def _write_manifest(self, home: str, files: list[File], about: dict) -> None:
        text = json.dumps(about)
        rows = [(*[list(v) if isinstance(v, tuple) else v for v in vars(f).values()], text) for f in files]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{home}/manifest")

    def _cut(self, folded: list[File], rows: DataFrame, met: dict, row_bytes: float, number: int) -> list[File]:
        """The splits that take the place of those folded, cut at quantiles so that each is below ``split_bytes``."""
        sizes, out = defaultdict(float), []
        for f in folded:
            live = f.bytes * (1 - f.marked / f.rows) if f.rows else 0
            sizes[f.split] += live
        for split, (added, replaced) in met.items():
            if split in sizes:
                sizes[split] += max(0, added - replaced) * row_bytes
        bounds = {f.split: (f.low, f.high) for f in folded}
        for split, (low, high) in sorted(bounds.items(), key=lambda b: (b[1][0] is not None, b[1][0] or 0)):
            parts = max(1, -(-int(max(0, sizes[split])) // self.split_bytes))
            cuts: list[int] = []
            if parts > 1:
                inside = rows
                if low is not None:
                    inside = inside.where(F.col(self.key) >= low)
                if high is not None:
                    inside = inside.where(F.col(self.key) < high)
                shares = [i / parts for i in range(1, parts)]
                found = inside.agg(F.percentile_approx(self.key, shares, max(10_000, 100 * parts))).first()[0] or []
                cuts = sorted({c for c in found if low is None or c > low})
            for a, b in zip([low, *cuts], [*cuts, high], strict=True):
                out.append(File(number, a, b))
                number += 1
        return out

    def _mark(self, home: str, gone: DataFrame) -> dict[str, int]:
        """Bitmaps of the places that go, and how many there are of each file."""
        (
            gone.groupBy(F.col(FILE).alias("file"), F.expr(f"bitmap_bucket_number({ROW} + 1)").alias("window"))
            .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({ROW} + 1))").alias("bits"), F.count(F.lit(1)).alias("n"))
            .write.parquet(f"{home}/marks")
        )
        marks = self.spark.read.schema("file string, window long, bits binary, n long").parquet(f"{home}/marks")
        return {r[0]: r[1] for r in marks.groupBy("file").agg(F.sum("n")).collect()}

    def _measured(self, home: str, ranges: dict) -> list[File]:
        rows = self.spark.read.option("basePath", f"{home}/data").schema(f"`{self.key}` long, {SPLIT} long").parquet(f"{home}/data")
        found = rows.groupBy(SPLIT, _file().alias(FILE)).agg(
            F.count(F.lit(1)), F.max("_metadata.file_size"), F.min(self.key), F.max(self.key)
        )
        return [File(r[0], *ranges[r[0]], r[1], r[2], r[3], r[4], r[5]) for r in found.collect()]

    def _located(self, rows: DataFrame, files: list[File]) -> DataFrame:
        """``rows`` with the split of their key. The key range is laid out in equal bins, about two for each split; a bin
        knows the splits that reach into it, so a row looks at a few and the directory is joined, not searched."""
        splits = sorted({(f.low, f.split) for f in files}, key=lambda s: (s[0] is not None, s[0] or 0))
        if len(splits) == 1:
            return rows.withColumn(SPLIT, F.lit(splits[0][1]).cast("long"))
        lows = [low for low, _ in splits if low is not None]
        width = max(1, (lows[-1] - lows[0]) // (2 * len(lows)))
        last = (lows[-1] - lows[0]) // width
        reach = defaultdict(list)
        for (low, split), (after, _) in zip(splits, [*splits[1:], (None, None)], strict=True):
            first = -1 if low is None else (low - lows[0]) // width
            to = last if after is None else (after - 1 - lows[0]) // width
            for number in range(max(-1, first), max(-1, to) + 1):
                reach[number].append((low, split))
        table = [(number, held) for number, held in reach.items()]
        bins = self.spark.createDataFrame(table, "_bin long, _held array<struct<low: long, split: long>>")
        at = F.floor((F.col(self.key).cast("decimal(20,0)") - F.lit(lows[0])) / F.lit(width))
        bin_of = F.least(F.greatest(at, F.lit(-1)), F.lit(last)).cast("long")
        joined = rows.withColumn("_bin", bin_of).join(bins, "_bin")
        key = F.col(self.key)
        chosen = F.array_max(F.filter("_held", lambda s: s["low"].isNull() | (s["low"] <= key)))
        return joined.withColumn(SPLIT, chosen["split"]).drop("_bin", "_held")

    def drop_superseded(self, keep: int = 2, after: int | None = None) -> list[str]:
        """Delete commits of which no file is current, sparing the last ``keep`` and those after number ``after``,
        and remains of writes that failed before them."""
        names, last = self._names(), self.newest()
        files, _ = self.manifest()
        used = {f.path.split("/")[0] for f in files if f.path} | {m for f in files for m in f.marks}
        finished = [n for n in names if self._finished(n)]
        spared = used | set(finished[len(finished) - keep :] if keep else []) | {last}
        if after is not None:
            spared |= {n for n in names if self.folder.number_of(n) > after}
        stale = [n for n in names if last and n < last and n not in spared]
        for name in stale:
            self.folder.delete(f"{self.root}/{name}")
        return stale


def _sides(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New rows with their split, and the places of old ones."""
    return feed.where("new IS NOT NULL").select("new.*", SPLIT), feed.where("old IS NOT NULL").select(SPLIT, FILE, ROW)


def _file() -> Column:
    """Path of a row's file below the table."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"(commit=\d{10}[^/]*/data/.*)$", 1)


def _ddl(about: dict) -> str:
    return StructType.fromJson(about["schema"]).simpleString()


def _widened(about: dict, schema: StructType) -> StructType:
    """The table's columns so far, and new ones after them."""
    known = StructType.fromJson(about["schema"]) if about else StructType([])
    fields = {f.name: f for f in known.fields}
    for f in schema.fields:
        fields[f.name] = f
    return StructType([type(f)(f.name, f.dataType, True) for f in fields.values()])


def _count(files: list[File]) -> dict[int, int]:
    count: dict[int, int] = defaultdict(int)
    for f in files:
        count[f.split] += f.path is not None
    return count


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges in order, those that touch put together."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
