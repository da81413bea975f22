"""Packing of token sequences into windows by best fit, longest first.

A document is cut into full windows, each a sequence of its own, and a remainder. Remainders are
dealt by a hash of their document into groups of about ``GROUP`` pieces; in a group, from the longest to the
shortest, each goes to the open window that it leaves fullest. A segment tree over remaining
capacities finds that window in as many steps as the capacity has bits. A group fills hundreds of
windows and leaves a handful open, so the padding does not depend on how many groups there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.base import texts, written
from wardlake.llm.encoding import library_encoder, slices
from wardlake.llm.token_shards import END_ID, VOCABULARY

WINDOW = 1024
GROUP = 4096
#: Sequences of a group are numbered from its number times this, which no group can reach.
NUMBERS = 1 << 32


class OpenWindows:
    """Windows by remaining capacity: leaf c of the tree counts those with capacity c."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.held[room].append(window)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (room, window) of the least room that is at least ``need``."""
        node = self.leaves + need
        if not self.count[node]:
            # Up to the first ancestor with something to its right, then down to the left.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.held[room].pop()


def best_fit(lengths: list[int], capacity: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window and offset of every length, by best fit from the longest; ties keep their order."""
    windows, offsets, opened = [0] * len(lengths), [0] * len(lengths), 0
    tree = OpenWindows(capacity)
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take_tightest(lengths[at])
        if found is None:
            found, opened = (capacity, opened), opened + 1
        room, windows[at] = found
        offsets[at] = capacity - room
        if room > lengths[at]:
            tree.add(room - lengths[at], windows[at])
    return windows, offsets


def pieces(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32-bit integers), doc_tokens: the full windows and
    the remainder of every document, whose ids end with ``END_ID``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(path), np.array([END_ID], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                encoded = encoder.many(batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    ids += end
                    total = len(ids) // 4
                    rows += [
                        (doc_id, at, min(window, total - at), ids[4 * at : 4 * (at + window)], total)
                        for at in range(0, total, window)
                    ]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.binary(), pa.int64()), strict=True)],
                    ["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long")


def pack(cut: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``cut`` (doc_id, start, length, and any more columns) with sequence_id and offset.

    Lengths are 1 to ``window``. Pieces of the full length are sequences of their own, numbered from
    -1 downwards in steps that depend on their row; others lie gapless from offset 0 of theirs.
    Every row is packed, also if rows repeat or ids are null; no rows give none.
    """
    full = cut.where(F.col("length") == window).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))
    schema = rest.schema
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups)))

    def fit(table: pa.Table) -> pa.Table:
        order = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        windows, offsets = best_fit(order.column("length").to_pylist(), window)
        first = order.column("_group")[0].as_py() * NUMBERS
        return (
            order.drop_columns(["_group"])
            .append_column("sequence_id", pa.array(np.array(windows, np.int64) + first))
            .append_column("offset", pa.array(offsets, pa.int64()))
        )

    packed = dealt.groupBy("_group").applyInArrow(fit, schema.add("sequence_id", "long").add("offset", "long"))
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of ``docs``.

    A null or empty text is its end id alone. Repeated rows are packed as often as they come.
    Texts are encoded once; what is shuffled is a few numbers per piece.
    """
    cut = pieces(docs, vocabulary).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(written(cut, "pieces"))


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids: the pieces of ``packed``, which has their ids, put together. A sequence
    has at most a window of ids."""
    return packed.groupBy("sequence_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"])), ""
        ).alias("hex_ids")
    ).select("sequence_id", F.unhex("hex_ids").alias("ids"))
