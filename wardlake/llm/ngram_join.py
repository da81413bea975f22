"""Jaccard self-join of word shingle sets by PartEnum signatures.

Two sets link when ``100 * |x & y| >= 75 * |x | y|``. Equal sets are one class and are treated once.

1. *Shared shingles.* A shingle that no other class has lies in no intersection, and a linked set has
   at most a quarter of its shingles outside the other. Classes with more private shingles than
   that are set aside: first judged by five sixteenths of the shingle domain, where a class
   with four fifths private shingles shows already, then, among those left, by all of it and only
   against classes of sizes that can link.
2. *Signatures.* Sizes fall into bands, each up to a third above the one below, so that linked sets
   lie in the same band or in neighbouring ones; a set takes part in its own band and the next. In
   a band whose sets have at most ``r`` shingles, linked sets differ in at most ``k = 2r/7`` places. The
   shingle domain is cut by a hash into ``n1`` partitions of ``n2`` parts each. If more than
   ``k / (k2 + 1)`` partitions of the larger set have more than ``k2`` parts in use, then in one of
   them at most ``k2`` parts differ, and some choice of ``n2 - k2`` parts is equal and not empty:
   every such choice is enumerated, and its content is a signature. The condition is counted for
   every set; should a set miss it, all are cut again by another hash.
3. *Verification.* Of the signatures that exactly the same sets share, one is kept. Every set is first
   compared with one other of the smallest group that it is in. Signature groups within one component then are done. The
   others, joined wherever they share a set, make up clusters. Sets that are near each other share many signatures, and then a
   cluster has not many more pairs than its groups have together: it is compared in tiles (see 5), each pair once, of which only links
   that connect something leave the task. In clusters whose groups overlap little, sets of different components that share a group
   and have not been compared are, unless their sizes or the parities of their sketches show that they differ in too many shingles.
4. *Components.* Least labels by alternating stars, as tables.
5. *Links.* Linked sets are in one component, so all pairs of each component are compared once more and
   counted. Large components are cut into cells of bounded size, and every two cells whose sizes may link
   meet in a tile: a set is shuffled once per tile, not once per pair, and no pair becomes a row.

No group of equal sets is expanded into pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.base import texts, written
from wardlake.llm.encoding import slices
from wardlake.llm.hashing import Words, as_arrays, as_lists, column_bytes, mixed, powers
from wardlake.session import run_folder

WORDS = 5
#: Sixteenths of the shingle domain that the first look at private shingles takes.
FIRST_SIXTEENTHS = 5
#: Rounds of one comparison per set.
HOOKS = 2
#: A cluster of signature groups is compared in tiles if it has at most this many times the pairs that its groups have.
TILED = 4
#: Longs of a set's sketch: one bit for the parity of each of 64 times as many parts of the domain.
SKETCH = 16
#: Bounds of a cell of a component: sets, and shingles of all of them unless one set alone has more.
CELL_SETS = 512
CELL_SHINGLES = 1 << 20
#: Bits of the filter that keeps most rows without likely sets from being shuffled: 4 MB. Being full
#: only lets more rows through.
FILTER_BITS = 1 << 25
_U = np.uint64
def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted set of 64-bit shingle hashes of every text of an Arrow string array."""
    words_of = Words(*column_bytes(column))
    hashes, first = words_of.hashes(), words_of.first
    rows = np.zeros(len(hashes), _U)
    for step in range(words):
        rows[: max(0, len(hashes) - step)] += hashes[step:] * _U(pow(0xD6E8FEB86659FD93, step + 1, 1 << 64))
    rows = mixed(rows, 2)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(rows[a : b - words + 1]))
        elif b > a:
            sets.append(mixed(combined(hashes[a:b]), 3 + b - a))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def combined(hashes: np.ndarray) -> np.ndarray:
    """One hash of a sequence of hashes."""
    up, _ = powers(1 << 16)
    return np.array([(hashes * up[1 : len(hashes) + 1]).sum(dtype=_U)], _U)


def fingerprints(found: list[np.ndarray]) -> list[bytes]:
    """16 bytes that stand for a set."""
    return [
        np.array([mixed(s, 11).sum(dtype=_U), mixed(s, 12).sum(dtype=_U) + _U(len(s))], _U).tobytes() for s in found
    ]


def places_of(doc_ids: pa.Array) -> list[np.ndarray]:
    """Two bits of the filter for every doc_id; null counts as 0."""
    hashes = mixed(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).view(_U), 21)
    return [(hashes >> _U(shift)) % _U(FILTER_BITS) for shift in (0, 32)]


def filter_of(rows: DataFrame) -> np.ndarray:
    """The filter of the doc_ids of ``rows``, as 64-bit words: at most FILTER_BITS / 64 rows reach
    the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(places_of(batch.column("doc_id")))
            masks = (_U(1) << (place % _U(64))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> _U(6)).astype(np.int32)), pa.array(masks)], ["word", "mask"])

    words = rows.select("doc_id").mapInArrow(run, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found, out = words.toArrow(), np.zeros(FILTER_BITS // 64, _U)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(_U)
    return out


def sets_of(docs: DataFrame, content: str = "", passing=None) -> DataFrame:
    """doc_id, key (16 bytes), short (8 of them), n_shingles and, as ``content`` says, ``shingles``: none, the
    "sample" for the first look, or the whole set ("shingles"). ``passing``: a broadcast filter of doc_ids."""
    schema = "doc_id long, key binary, short long, n_shingles long" + (", shingles array<long>" if content else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                if passing is not None:
                    in_word = [(passing.value[p >> _U(6)] >> (p % _U(64))) & _U(1) for p in places_of(batch.column("doc_id"))]
                    batch = batch.filter(pa.array((in_word[0] & in_word[1]).astype(bool)))
                found = shingle_sets(batch.column("text"))
                keys = fingerprints(found)
                columns = {
                    "doc_id": batch.column("doc_id"),
                    "key": pa.array(keys, pa.binary()),
                    "short": pa.array(np.frombuffer(b"".join(k[:8] for k in keys), np.int64)),
                    "n_shingles": pa.array([len(s) for s in found], pa.int64()),
                }
                if content == "sample":
                    columns["shingles"] = as_lists([s[: np.searchsorted(s, _U(FIRST_SIXTEENTHS << 60))] for s in found])
                elif content == "shingles":
                    columns["shingles"] = as_lists(found)
                yield pa.RecordBatch.from_pydict(columns)

    return texts(docs).mapInArrow(run, schema)


def without_private(classes: DataFrame, private: DataFrame, by: str) -> DataFrame:
    """Classes with at most a quarter of their shingles in ``private`` (by, ...; a row for each)."""
    n = private.groupBy(by).agg(F.count(F.lit(1)).alias("private"))
    return classes.join(n, by, "left").where("4 * coalesce(private, 0) <= n_shingles").drop("private")


def alone(rows: DataFrame, holder: str, *group: str) -> DataFrame:
    """``holder`` and ``group`` of those groups of ``rows`` that only one holder is in. A hot group
    sends one row per task."""
    least = rows.groupBy(*group).agg(F.min(holder).alias(holder), F.max(holder).alias("other"))
    return least.where(f"{holder} = other").drop("other")


def without_private_in_bands(sets: DataFrame) -> DataFrame:
    """``sets`` (cls, n_shingles, shingles) without those of mostly private shingles, where only
    sets of the same and neighbouring bands count as others: both groups of a shingle, for the
    set's own band and the next, must have no one else."""
    ends = F.array(*map(F.lit, band_ends()))
    band = F.size(F.filter(ends, lambda end: end < F.col("n_shingles")))
    rows = sets.select("cls", "shingles", band.alias("band")).select("cls", "band", F.explode("shingles").alias("shingle"))
    both = rows.select("cls", "shingle", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    private = alone(both, "cls", "shingle", "band").groupBy("cls", "shingle").agg(F.count(F.lit(1)).alias("n")).where("n = 2")
    left = without_private(sets.select("cls", "n_shingles"), private, "cls")
    return sets.join(left.select("cls"), "cls")


@functools.lru_cache(maxsize=4096)
def scheme(r: int) -> tuple[int, int, int]:
    """(n1, n2, k2) for sets of at most ``r`` shingles: the coarsest cut, and so the longest
    signatures, under which a set misses the condition only by a deviation of over 7 sigma. n1 = 0
    makes every shingle a partition of its own, which meets it always."""

    def holds(n1: int, n2: int, k2: int) -> bool:
        for size in (r, max(1, 3 * r // 4)):
            used = 1 - math.exp(-size / (n1 * n2))
            rich = 1 - sum(math.comb(n2, i) * used**i * (1 - used) ** (n2 - i) for i in range(k2 + 1))
            if n1 * rich - 7 * math.sqrt(n1 * rich * (1 - rich)) <= 2 * size // 7 // (k2 + 1):
                return False
        return True

    tries = [(r // per, 4, 1) for per in (6, 5, 4, 3)] + [(r // per, 1, 0) for per in (3, 2, 1)]
    return next((t for t in tries if t[0] and holds(*t)), (0, 1, 0))


@functools.lru_cache(maxsize=1)
def band_ends(most: int = 1 << 40) -> list[int]:
    ends = [1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, 4 * (ends[-1] + 1) // 3))
    return ends


def signatures(shingles: np.ndarray, seed: int = 0) -> tuple[np.ndarray, bool]:
    """Signatures of a set in its band and the next, and whether it meets the condition in its own."""
    band = int(np.searchsorted(band_ends(), len(shingles)))
    out, safe = [], True
    for at in (band, band + 1):
        r = band_ends()[at]
        n1, n2, k2 = scheme(r)
        if not n1:
            out.append(mixed(shingles, 1000 + at))
            continue
        cell = (mixed(shingles, 100 + 7 * seed) % _U(n1 * n2)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cells, edges = np.unique(cell[order], return_index=True)
        content, used = np.zeros(n1 * n2, _U), np.zeros(n1 * n2, np.int64)
        content[cells] = np.add.reduceat(mixed(shingles, 101)[order], edges)
        used[cells] = 1
        content, used = content.reshape(n1, n2), used.reshape(n1, n2)
        if at == band:
            rich = int((used.sum(1) > k2).sum())
            safe = rich > 2 * len(shingles) // 7 // (k2 + 1)
        whole, parts = content.sum(1, dtype=_U), used.sum(1)
        for left_out in range(n2) if k2 else [-1]:
            rest = whole - (content[:, left_out] if k2 else _U(0))
            full = parts - (used[:, left_out] if k2 else 0) > 0
            place = (np.arange(n1) * n2 + max(0, left_out)).astype(_U)
            out.append(mixed(mixed(rest, 200 + at) + mixed(place, 300 + at))[full])
    return np.unique(np.concatenate(out)), safe


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of a set in parts of the domain. Two sketches differ in at most as many bits as the
    sets in shingles."""
    counts = np.bincount((mixed(shingles, 400) % _U(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits(counts & 1 == 1).view(_U)


def signed(sets: DataFrame, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = as_arrays(batch.column("shingles"))
            found = [signatures(shingles, seed) for shingles in arrays]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cls"), batch.column("n_shingles"), pa.array([safe for _, safe in found], pa.bool_()),
                    as_lists([signed for signed, _ in found]), as_lists([sketch(shingles) for shingles in arrays]),
                ],
                ["cls", "n_shingles", "safe", "signatures", "sketch"],
            )

    return sets.select("cls", "n_shingles", "shingles").mapInArrow(
        run, "cls long, n_shingles long, safe boolean, signatures array<long>, sketch array<long>"
    )


def measures(table: DataFrame) -> DataFrame:
    words = [F.element_at("sketch", i + 1).alias(f"s{i}") for i in range(SKETCH)]
    return table.select("cls", "n_shingles", *words)


#: Whether the sizes and sketches of two sets, a and b, leave it open that they link.
LINKABLE = (
    "4 * least(a_n_shingles, b_n_shingles) >= 3 * greatest(a_n_shingles, b_n_shingles) and 7 * ("
    + " + ".join(f"bit_count(a_s{i} ^ b_s{i})" for i in range(SKETCH))
    + ") <= a_n_shingles + b_n_shingles"
)


def may_link(pairs: DataFrame, table: DataFrame, *ends: str) -> DataFrame:
    """Those of ``pairs`` whose two classes, in the columns ``ends``, may link."""
    found = pairs
    for x, end in zip("ab", ends, strict=True):
        own = measures(table)
        found = found.join(own.select([F.col(c).alias(end if c == "cls" else f"{x}_{c}") for c in own.columns]), end)
    return found.where(LINKABLE).select(pairs.columns)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b: classes) with ``link``: whether their sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(as_arrays(batch.column("a_set")), as_arrays(batch.column("b_set")), strict=True):
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                links.append(100 * shared >= 75 * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(links, pa.bool_())], ["a", "b", "link"])

    a, b = (sets.select(F.col("cls").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set").mapInArrow(
        run, "a long, b long, link boolean"
    )


def components(edges: DataFrame, folder: str) -> DataFrame:
    """cls and component (the least class connected with it) of every end of ``edges`` (a, b).

    Alternating stars: every node points its larger neighbours, then its smaller ones, to the least
    of them, until nothing changes.
    """
    def least(rows: DataFrame) -> DataFrame:
        return rows.groupBy("node").agg(F.min("next").alias("low"))

    def both(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
            rows.select(F.col("b").alias("node"), F.col("a").alias("next"))
        )

    def trace(rows: DataFrame):
        return rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()

    step = 0
    current = written(edges.where("a != b").select("a", "b").distinct(), "edges-0", folder)
    before = trace(current)
    while before[0]:
        step += 1
        around = both(current)
        low = least(around).withColumn("low", F.least("low", "node"))
        large = around.join(low, "node").where("next > node").select(F.col("next").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a != b").distinct(), f"large-{step}", folder)
        down = large.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("next"))
        joined = down.join(least(down), "node")
        small = joined.select(F.col("next").alias("a"), F.col("low").alias("b")).unionByName(
            joined.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
        current = written(small.where("a != b").distinct(), f"edges-{step}", folder)
        after = trace(current)
        if after == before:
            break
        before = after
    found = current.select(F.col("a").alias("cls"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("cls"), F.col("b").alias("component")).distinct()
    return found.unionByName(roots)


def clusters_of(open_rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Clusters of the signature groups of ``open_rows`` (signature, n, cls, component, lead), which hold every two sets that
    share one: cls and component (the cluster) of those with at most ``TILED`` times the pairs of sets that their groups
    have together, and the rows of the others."""
    members = components(open_rows.select(F.col("cls").alias("a"), F.col("lead.cls").alias("b")), f"{folder}/clusters")
    members = written(members.withColumnRenamed("component", "cluster"), "clusters/members", folder)
    pairs = members.groupBy("cluster").agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("pairs"))
    grouped = open_rows.join(members, "cls").groupBy("cluster").agg(F.sum("n").alias("grouped"))
    dense = written(pairs.join(grouped, "cluster").where(F.col("pairs") <= TILED * F.col("grouped")).select("cluster"), "clusters/dense", folder)
    inside = members.join(dense, "cluster", "left_semi")
    rest = open_rows.join(inside, "cls", "left_anti")
    return inside.select("cls", F.col("cluster").alias("component")), rest


def class_components(sets: DataFrame, folder: str) -> DataFrame:
    """(cls, component) of classes that link with another.

    ``sets``: cls, n_shingles, shingles. Only the links needed to connect the components are looked for.
    """
    spark = sets.sparkSession
    for seed in range(20):
        table = written(signed(sets, seed), f"signed-{seed}", folder)
        if table.where("not safe").isEmpty():
            break
    else:
        raise RuntimeError("no cut of the shingle domain suits all sets")
    rows = table.select("cls", F.explode("signatures").alias("signature"))
    # Of the signatures that the same sets share, one is enough.
    members = [F.bit_xor(F.xxhash64("cls", F.lit(salt))).alias(f"members_{salt}") for salt in (1, 2)]
    groups = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), *members).where("n > 1")
    chosen = groups.groupBy("n", "members_1", "members_2").agg(F.min("signature").alias("signature"))
    rows = written(rows.join(chosen.select("signature", "n"), "signature"), "shared", folder)
    links = spark.createDataFrame([], "a long, b long, link boolean")
    labels = spark.createDataFrame([], "cls long, component long")
    for hook in range(HOOKS + 1):
        placed = rows.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        # Groups that more than one component shares, and a member of the least of these.
        mixed_groups = (
            placed.groupBy("signature")
            .agg(F.min(F.struct("component", "cls")).alias("lead"), F.max("component").alias("high"))
            .where("lead.component != high")
            .select("signature", "lead")
        )
        open_rows = placed.join(mixed_groups, "signature")
        compared = links.select("a", "b")
        if hook < HOOKS:
            # One comparison per set: with the leader of the smallest group, whose members have
            # most in common, among those that it may link with and has not been compared with.
            leaders = open_rows.where("component != lead.component").groupBy("cls", F.col("lead.cls").alias("leader"))
            pairs = (
                may_link(leaders.agg(F.min("n").alias("n")), table, "cls", "leader")
                .select("cls", "n", F.least("leader", "cls").alias("a"), F.greatest("leader", "cls").alias("b"))
                .join(compared, ["a", "b"], "left_anti")
                .groupBy("cls")
                .agg(F.min(F.struct("n", "a", "b")).alias("pair"))
                .select("pair.a", "pair.b")
                .distinct()
            )
        else:
            open_rows = written(open_rows, "open", folder)
            dense, rest = clusters_of(open_rows, folder)
            connecting = tiled(sets, dense, forest, "a long, b long", f"{folder}/clusters")
            connecting = written(connecting.withColumn("link", F.lit(True)), "connecting", folder)
            links = links.unionByName(connecting)
            # Sizes and sketches rule out most pairs that cannot link before they become rows.
            sized = rest.select("signature", "cls", "component").join(measures(table), "cls")
            left, right = (
                sized.select([F.col(c).alias(f"{x}_{c}") if c != "signature" else F.col(c) for c in sized.columns]) for x in "ab"
            )
            pairs = (
                left.join(right, "signature")
                .where("a_cls < b_cls and a_component != b_component")
                .where(LINKABLE)
                .select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b"))
                .distinct()
                .join(compared, ["a", "b"], "left_anti")
            )
        found = written(linked(written(pairs, f"pairs-{hook}", folder), sets), f"links-{hook}", folder)
        links = links.unionByName(found)
        labels = written(components(links.where("link"), f"{folder}/stars-{hook}"), f"labels-{hook}", folder)
    return labels


def shared_counts(sets: list[np.ndarray], left: int, right: int) -> np.ndarray:
    """How many elements each of the first ``left`` sets shares with each one from place ``right`` on."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number, use = np.cumsum(holders > 1) - 1, holders[column] > 1
    member, column = member[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    out, width = np.zeros((left, len(sets) - right)), max(1, (1 << 22) // len(sets))
    for low in range(0, int((holders > 1).sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        has = np.zeros((len(sets), min(width, int((holders > 1).sum()) - low)), np.float32)
        has[member[a:b], column[a:b] - low] = 1
        out += has[:left] @ has[right:].T
    return out


def links_of(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The classes of a tile, and the symmetric matrix of their links. Of a tile of two cells, only links between them are looked for."""
    first = table.column("first").to_numpy()
    order = np.argsort(~first, kind="stable")
    table = table.take(pa.array(order)).combine_chunks()
    found, left = as_arrays(table.column("shingles").chunk(0)), int(first.sum())
    link = np.zeros((len(found), len(found)), bool)
    own = table.column("own")[0].as_py()
    if own or 0 < left < len(found):
        sizes = np.array([len(s) for s in found])
        right = 0 if own else left
        shared = shared_counts(found, left, right)
        link[:left, right:] = 100 * shared >= 75 * (sizes[:left, None] + sizes[None, right:] - shared)
        if own:
            np.fill_diagonal(link, False)
        else:
            link[left:, :left] = link[:left, left:].T
    return table.column("cls"), link


def degrees(cls: pa.Array, link: np.ndarray) -> pa.Table:
    """cls and links, how many others of the tile link with it."""
    return pa.table({"cls": cls, "links": pa.array(link.sum(1).astype(np.int64))})


def forest(cls: pa.Array, link: np.ndarray) -> pa.Table:
    """Links or chains of links, a and b, that connect all that the tile's links do: fewer than it has classes."""
    waiting, names = np.ones(len(link), bool), cls.to_numpy()
    a, b = [], []
    for start in range(len(link)):
        reached = [start] if waiting[start] else []
        waiting[start] = False
        for at in reached:
            near = np.flatnonzero(link[at] & waiting)
            waiting[near] = False
            reached += near.tolist()
        a += [start] * len(reached[1:])
        b += reached[1:]
    return pa.table({"a": names[np.array(a, np.int64)], "b": names[np.array(b, np.int64)]})


def tiled(sets: DataFrame, labels: DataFrame, of_links, schema: str, folder: str) -> DataFrame:
    """``of_links`` (classes, matrix of their links) of the tiles of every component of ``labels`` (cls, component).
    A component is cut into cells by band, and every two cells whose sizes may link meet in a tile."""
    ends = F.array(*map(F.lit, band_ends()))
    placed = sets.select("cls", "n_shingles").join(labels, "cls")
    totals = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    whole = totals.select("component", ((F.col("n") <= CELL_SETS) & (F.col("size") <= CELL_SHINGLES)).alias("whole"))
    band = F.size(F.filter(ends, lambda end: end < F.col("n_shingles")))
    banded = placed.join(whole, "component").withColumn("band", F.when(F.col("whole"), 0).otherwise(band))
    cuts = banded.groupBy("component", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CELL_SETS), F.ceil(F.sum("n_shingles") / CELL_SHINGLES)).alias("parts")
    )
    cuts = written(cuts, "cuts", folder)
    cell = banded.join(cuts, ["component", "band"]).select(
        "cls", F.struct("component", "band", F.expr("pmod(xxhash64(cls), parts)").alias("part")).alias("cell")
    )
    cells = cuts.select("component", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    a, b = (cells.select("component", F.struct("component", "band", "part").alias(x)) for x in "ab")
    # Linked sets lie in the same band or in neighbouring ones.
    tiles = a.join(b, "component").where("(a.band = b.band and a.part <= b.part) or a.band + 1 = b.band")
    sides = tiles.select("a", "b", F.explode(F.when(F.expr("a = b"), F.array("a")).otherwise(F.array("a", "b"))).alias("cell"))
    rows = sides.join(cell, "cell")
    rows = rows.select("a", "b", "cls", F.expr("cell = a").alias("first"), F.expr("a = b").alias("own")).join(sets, "cls")
    return rows.groupBy("a", "b").applyInArrow(lambda table: of_links(*links_of(table)), schema)


def link_counts(sets: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """cls and links (how many other classes link with it), for classes of ``labels`` (cls, component)."""
    counted = tiled(sets, labels, degrees, "cls long, links long", folder)
    return counted.groupBy("cls").agg(F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, links (how many other classes, sets of different shingles, link with
    the row's own): one row for each row of ``docs``.

    component_id is the least doc_id that is reachable by links, the row's own included. Texts
    without a word, null or empty, have no shingles and are linked with nothing: their component is
    their own doc_id. Rows with the same words are linked. A null doc_id takes part, but names
    no component unless all of its component are null. No rows give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark)
    members = written(sets_of(docs), "members", folder)
    classes = members.where("n_shingles > 0").groupBy("key", "short", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "classes", folder)
    sample = sets_of(docs, "sample").select("short", F.explode("shingles").alias("shingle"))
    likely = written(without_private(classes, alone(sample, "short", "shingle"), "short"), "likely", folder)
    passing = spark.sparkContext.broadcast(filter_of(likely))
    wanted = likely.select("cls", F.col("key").alias("wanted"), F.col("doc_id").alias("wanted_id"))
    sets = (
        sets_of(docs, "shingles", passing)
        .join(wanted, (F.col("key") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))
        .groupBy("cls", "n_shingles")
        .agg(F.first("shingles").alias("shingles"))
    )
    sets = written(without_private_in_bands(written(sets, "likely-sets", folder)), "sets", folder)
    labels = class_components(sets, folder)
    degree = link_counts(sets, labels, folder)
    placed = classes.join(labels, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    lowest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(lowest, "component").join(degree, "cls", "left").select("key", "component_id", "links")
    return members.join(named, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )
