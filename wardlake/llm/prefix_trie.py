"""The trie of all prefixes of conversations, built from adaptive radix trees.

A turn is a big-endian number of ``TURN_BYTES`` bytes, the digest of its role and text; a conversation is the string
of its turns. Strings are cut into segments of ``SEGMENT`` turns, so that no conversation, however long, is
one row. A segment starts at a node that a digest of all turns before names. Equal segments of one node are
counted once, whoever has them. They are then dealt in ranges of (node, string): neighbours share prefixes,
and a node with any number of continuations is spread over many tasks. A task puts its segments into
radix trees, and only depths where a turn ends give nodes; other tasks may have a part of the same node, so the parts
are added up by its digest.

What sums over a subtree has two steps. Within a segment every node knows its ancestors. Between segments, sums go up
in doubling steps along the chain of segments, so 2**k segments take k rounds; conversations of one segment take none.

Ids of a node's own conversations are written out in sorted pieces; one digest reads them in their order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.base import numbered, written
from wardlake.llm.radix_tree import Node, insert
from wardlake.session import run_folder, ship_package

TURN_BYTES = 16
#: Turns of a segment; also the longest list of ancestors of a node.
SEGMENT = 16
#: Segments of one conversation whose sums one window adds up.
WINDOW_SEGMENTS = 4096
#: Segments put into one tree before it is given out; and nodes, pieces and ids of an Arrow batch.
TREE_SEGMENTS = 1 << 15
BATCH_ROWS = 8192
ROOT = b""
# Fixed values of the rebuilding: conversations of a family, and the modulus of the shared length.
FAMILY = 5
SHARED = 9
PARTS = "node binary, parent binary, segment binary, depth long, n long, conv long, bytes long, above array<binary>"


def digest(of: Column) -> Column:
    return F.substring(F.unhex(F.sha2(of, 256)), 1, TURN_BYTES)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place in the conversation, from 0), n (its turns), turn (the number of role and text), bytes (of the
    text). Rows without a conv_id belong to no conversation. A null turn comes first; rows of one turn
    are ordered by their numbers."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("number"),
        digest(marked.cast("binary")).alias("turn"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = numbered(rows, "conv_id", F.col("number").asc_nulls_first(), "turn")
    first = written(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "conversations")
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("at"), "n", "turn", "bytes")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, at, total, turn, bytes) and conversations (conv_id, total) after every conversation c has
    been given the first ``crc32(c) % SHARED`` turns of conversation ``c - c % FAMILY`` for its own first ones.
    ``placed`` is a written table of ``turns``."""
    own = placed.where("at = 0").select(
        "conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("lender"),
    )
    lenders = placed.where("at = 0").select(F.col("conv_id").alias("lender"), F.col("n").alias("lent"))
    lead = F.least("h", F.coalesce("lent", F.lit(0).cast("long")))
    known = written(
        own.join(lenders, "lender", "left")
        .withColumn("lead", lead)
        .select("conv_id", "lender", "h", "lead", (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")),
        "rebuilt",
    )
    kept = placed.join(known, "conv_id").where("at >= h")
    kept = kept.select("conv_id", (F.col("at") - F.col("h") + F.col("lead")).alias("at"), "total", "turn", "bytes")
    heads = placed.where(F.col("at") < SHARED - 1).select(F.col("conv_id").alias("lender"), "at", "turn", "bytes")
    borrowed = known.where("lead > 0").join(heads, "lender").where("at < lead")
    return kept.unionByName(borrowed.select(*kept.columns)), known.select("conv_id", "total")


def segments(rows: DataFrame) -> DataFrame:
    """One row for each segment of each conversation: conv_id, nth, is_last, segment (the node it starts at), string, bytes
    (of each turn's text), node (where it ends)."""
    turn = F.struct("at", "turn", "bytes")
    cut = (
        rows.groupBy("conv_id", F.expr(f"at div {SEGMENT}").alias("nth"))
        .agg(F.array_sort(F.collect_list(turn)).alias("t"), F.max("total").alias("total"))
        .select(
            "conv_id", "nth", "total",
            F.aggregate("t", F.lit(b""), lambda joined, t: F.concat(joined, t["turn"])).alias("string"),
            F.transform("t", lambda t: t["bytes"]).alias("bytes"),
        )
    )
    cut = written(cut, "cut")
    short, long = cut.where(F.col("total") <= SEGMENT), cut.where(F.col("total") > SEGMENT)
    # What names a node between segments: two sums over the segments before, each told from the others by its place.
    sums = {f"s{i}": F.xxhash64(F.lit(i), "nth", "string").cast("decimal(38,0)") for i in (1, 2)}
    long = long.withColumns(sums).withColumn("window", F.expr(f"nth div {WINDOW_SEGMENTS}"))
    windows = long.groupBy("conv_id", "window").agg(*[F.sum(s).alias(f"of_{s}") for s in sums])
    earlier = Window.partitionBy("conv_id").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    windows = windows.select("conv_id", "window", *[F.coalesce(F.sum(f"of_{s}").over(earlier), F.lit(0)).alias(f"of_{s}") for s in sums])
    before = Window.partitionBy("conv_id", "window").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    within = {f"in_{s}": F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sums}
    long = long.withColumns(within).join(windows, ["conv_id", "window"])
    start = digest(F.concat_ws("/", *[(F.col(f"of_{s}") + F.col(f"in_{s}")).cast("string") for s in sums]).cast("binary"))
    end = digest(F.concat_ws("/", *[(F.col(f"of_{s}") + F.col(f"in_{s}") + F.col(s)).cast("string") for s in sums]).cast("binary"))
    at_root = F.lit(ROOT)
    inner = digest(F.concat("segment", "string"))
    full = F.length("string") == SEGMENT * TURN_BYTES
    alone = digest(F.concat_ws("/", *[s.cast("string") for s in sums.values()]).cast("binary"))
    columns = ["conv_id", "nth", F.expr(f"nth = (total - 1) div {SEGMENT}").alias("is_last"), "segment", "string", "bytes", "node"]
    long = long.withColumn("segment", F.when(F.col("nth") == 0, at_root).otherwise(start)).withColumn(
        "node", F.when(full, end).otherwise(inner)
    )
    short = short.withColumn("segment", at_root).withColumn("node", F.when(full, alone).otherwise(inner))
    return short.select(*columns).unionByName(long.select(*columns))


class Found:
    """Nodes on their way into Arrow batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def walk(self, node: Node, before: bytes, segment: bytes, nth: int, above: list[bytes]) -> tuple[int, int, list[int]]:
        """Adds the nodes at and below ``node`` where a turn ends; returns how many conversations
        those are, the least, and the text bytes of one of their segments."""
        string = before + node.path
        first = len(above) + 1
        for depth in range(first, len(string) // TURN_BYTES + 1):
            if node.value and depth * TURN_BYTES == len(string):
                key = node.value[3]
            else:
                key = hashlib.sha256(segment + string[: depth * TURN_BYTES]).digest()[:TURN_BYTES]
            above = [*above, key]
        n, least, sizes = node.value[:3] if node.value else (0, None, None)
        for byte, below in node.by_byte():
            more, other, found = self.walk(below, string + bytes([byte]), segment, nth, above)
            n, sizes = n + more, found
            least = other if least is None else min(least, other)
        root = [ROOT] if segment == ROOT else []
        for depth in range(first, len(above) + 1):
            parent = above[depth - 2] if depth > 1 else segment
            self.rows.append(
                (above[depth - 1], parent, segment, nth * SEGMENT + depth, n, least, sizes[depth - 1], root + above[:depth])
            )
        return n, least, sizes

    def batch(self) -> pa.RecordBatch:
        types = [pa.binary()] * 3 + [pa.int64()] * 4 + [pa.list_(pa.binary())]
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(types)
        self.rows = []
        names = [field.split(" ")[0] for field in PARTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Radix trees of sorted (segment, string) rows, a new one with every start; their nodes."""
    found, tree, held, at = Found(), Node(), 0, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("segment", "nth", "string", "n", "conv", "bytes", "node")), strict=True):
            segment, nth, string, *value = row
            if at is not None and ((segment, nth) != at or held == TREE_SEGMENTS):
                found.walk(tree, b"", *at, [])
                tree, held = Node(), 0
                if len(found.rows) >= BATCH_ROWS:
                    yield found.batch()
            at, held = (segment, nth), held + 1
            insert(tree, string, tuple(value))
    if at is not None:
        found.walk(tree, b"", *at, [])
    yield found.batch()


def id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) rows to pieces of decimal ids joined by commas: node, task, piece, text."""
    task, piece = TaskContext.get().partitionId(), 0
    for batch in batches:
        nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
        edges = [0, *[i for i in range(1, len(nodes)) if nodes[i] != nodes[i - 1]], len(nodes)]
        runs = [(nodes[a], ",".join(map(str, ids[a:b]))) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in runs], pa.binary()),
                pa.array([task] * len(runs), pa.int32()),
                pa.array(range(piece, piece + len(runs)), pa.int64()),
                pa.array([r[1] for r in runs], pa.string()),
            ],
            ["node", "task", "piece", "text"],
        )
        piece += len(runs)


def id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to node and the SHA-256 digest of all of them joined by commas."""
    at, state = None, None
    for batch in batches:
        done = []
        for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if node == at:
                state.update(b",")
            else:
                if state:
                    done.append((at, state.hexdigest()))
                at, state = node, hashlib.sha256()
            state.update(text.encode())
        yield digests(done)
    if state:
        yield digests([(at, state.hexdigest())])


def digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"]
    )


def below_segments(weighed: DataFrame, folder: str) -> DataFrame:
    """start, leaves, saved: sums over all nodes below each node that segments start at."""
    sums = [F.sum("leaf").alias("leaves"), F.sum("own").alias("saved")]
    ups = weighed.where(f"depth % {SEGMENT} = 0 and depth > 0").select(F.col("node").alias("start"), F.col("segment").alias("up"))
    state = weighed.where("depth > 0").groupBy(F.col("segment").alias("start")).agg(*sums).join(ups, "start", "left")
    state, rounds = written(state, "sums-0", folder), 0
    while not state.where("up is not null").isEmpty():
        # Each start holds the sums of the starts less than 2**rounds below it; ``up`` is the one so far above.
        rising = state.where("up is not null").groupBy(F.col("up").alias("start"))
        given = written(rising.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")), f"rising-{rounds}", folder)
        higher = state.select(F.col("start").alias("up"), F.col("up").alias("higher"))
        rounds += 1
        state = written(
            state.join(given, "start", "left").join(higher, "up", "left").select(
                "start",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("higher").alias("up"),
            ),
            f"sums-{rounds}",
            folder,
        )
    return state.drop("up")


def trie(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv_id, at from 0 without gaps, total, turn, bytes) and ``conversations`` (conv_id,
    total; also those without turns): node, parent, conv_id (the least), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    folder = run_folder(rows.sparkSession)
    cut = written(segments(rows), "segments", folder)
    distinct = cut.groupBy("segment", "nth", "string").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"), F.any_value("bytes").alias("bytes"), F.any_value("node").alias("node")
    )
    distinct = written(distinct, "distinct", folder)
    order = ["segment", "nth", "string"]
    parts = distinct.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(trees, PARTS)
    top = conversations.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv")).where("n > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("binary").alias("segment"),
        F.lit(0).cast("long").alias("depth"), "n", "conv", F.lit(0).cast("long").alias("bytes"), F.array(F.lit(ROOT)).alias("above"),
    )
    same = ["parent", "segment", "depth", "bytes", "above"]
    merged = parts.groupBy("node").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.any_value(c).alias(c) for c in same])
    nodes = written(merged.unionByName(top), "nodes", folder)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    children = written(children, "children", folder)
    weighed = nodes.join(children, "node", "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
            "leaf": F.col("n_children").isNull().cast("long"),
            "own": (F.col("n") - 1) * F.col("bytes"),
        }
    )
    weighed = written(weighed, "weighed", folder)
    below = below_segments(weighed, folder)
    deeper = weighed.select("node", "above", "leaf", "own").join(below.withColumnRenamed("start", "node"), "node", "left")
    # The root's sums come by way of the first segments' nodes.
    rest = F.when(F.col("node") != F.lit(ROOT), F.struct("leaves", "saved"))
    sums = (
        deeper.select(
            F.explode("above").alias("node"),
            (F.col("leaf") + F.coalesce(rest["leaves"], F.lit(0))).alias("leaf"),
            (F.col("own") + F.coalesce(rest["saved"], F.lit(0))).alias("own"),
        )
        .groupBy("node")
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("own").alias("saved_tokens"))
    )
    ends = cut.where("is_last").select("node", "conv_id").unionByName(
        conversations.where("total = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    )
    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        id_pieces, "node binary, task int, piece long, text string"
    )
    ended = pieces.repartition("node").sortWithinPartitions("node", "task", "piece").mapInArrow(id_digests, "node binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        weighed.join(sums, "node")
        .join(ended, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "node", "parent", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
            "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations; see ``rebuilt`` and ``trie``.

    ``conversations`` has conv_id, turn, role and text; other columns are not read. Null roles and texts are empty
    ones, rows without a conv_id are left out, null turns come first, and rows of one turn, equal ones too, are all
    turns, ordered by the digest of role and text. Texts of any length are one digest. A conversation
    with nothing left is a member of the root alone. An empty table has no nodes, not even the root.
    """
    ship_package(conversations.sparkSession)
    rows, members = rebuilt(written(turns(conversations), "turns"))
    return trie(rows, members)
