"""Token ids as wavelet matrices, one compressed file per shard.

Documents in ascending doc_id order are cut into shards of about ``SHARD_TOKENS`` ids. A shard keeps
its ids as one bit plane per bit of an id, from the highest: a plane holds that bit of every id in
the order left by the planes above, which put zeros before ones. With the counts of ones before each
block of bits, an id is read, counted or found again in as many steps as it has bits, without
unpacking the shard. A shard is a row, and a row is a Parquet file: its pages are compressed, its
columns can be read alone, and Spark's commit makes a lost writer harmless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.base import texts
from wardlake.llm.encoding import library_encoder, slices

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SHARD_TOKENS = 1 << 20
BLOCK = 512
SHARD_SCHEMA = (
    "part int, shard int, n_tokens long, doc_ids array<long>, lengths array<long>,"
    " zeros array<long>, planes array<binary>, ones_before array<binary>"
)


class WaveletMatrix:
    """Rank and select over a sequence of ids."""

    def __init__(self, length: int, zeros: list[int], planes: list[bytes], ones_before: list[bytes]):
        self.length, self.zeros = length, list(zeros)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.before = [np.frombuffer(b, "<u4") for b in ones_before]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max(initial=0)).bit_length())
        ids = narrow(ids, bits)
        zeros, planes, before = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = ids & ids.dtype.type(1 << level) != 0
            packed = np.packbits(bit)
            ones = np.bitwise_count(packed).astype("<u4")
            blocks = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else ones
            planes.append(packed.tobytes())
            before.append(np.concatenate([[0], np.cumsum(blocks)]).astype("<u4").tobytes())
            ids = np.concatenate([ids.take(np.flatnonzero(~bit)), ids.take(np.flatnonzero(bit))])
            zeros.append(len(ids) - int(ones.sum()))
        return cls(len(ids), zeros, planes, before)

    def ones(self, level: int, at: int) -> int:
        """Ones of a plane before a place."""
        block = at // BLOCK
        first = block * BLOCK // 8
        part = np.unpackbits(self.planes[level][first : (at + 7) // 8])[: at - block * BLOCK]
        return int(self.before[level][block]) + int(part.sum())

    def bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at // 8]) >> (7 - at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self.bit(level, at), self.ones(level, at)
            value = value << 1 | bit
            at = zeros + ones if bit else at - ones
        return value

    def span(self, token: int, at: int) -> tuple[int, int]:
        """Where the occurrences of an id before a place lie below the last plane."""
        if token >> len(self.zeros):
            return 0, 0
        start, end = 0, at
        for level, zeros in enumerate(self.zeros):
            a, b = self.ones(level, start), self.ones(level, end)
            one = token >> (len(self.zeros) - 1 - level) & 1
            start, end = (zeros + a, zeros + b) if one else (start - a, end - b)
        return start, end

    def count(self, token: int, at: int | None = None) -> int:
        """Occurrences of an id before a place, or in all."""
        start, end = self.span(token, self.length if at is None else at)
        return end - start

    def select(self, token: int, nth: int) -> int:
        """The place of the nth occurrence, from 0."""
        start, end = self.span(token, self.length)
        if not 0 <= nth < end - start:
            raise IndexError(nth)
        at = start + nth
        for level in range(len(self.zeros) - 1, -1, -1):
            one = token >> (len(self.zeros) - 1 - level) & 1
            at = self.place(level, one, at - self.zeros[level] if one else at)
        return at

    def place(self, level: int, one: int, nth: int) -> int:
        """The place of the nth one, or zero, of a plane."""
        before = self.before[level].astype(np.int64)
        if not one:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.length) - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        first = block * BLOCK // 8
        bits = np.unpackbits(self.planes[level][first : first + BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == one)[nth - int(before[block])])

    def all(self) -> np.ndarray:
        """Every id, in order: the planes are undone from the last to the first."""
        ids = narrow(np.zeros(self.length, np.uint32), len(self.zeros))
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.length).view(bool)
            above = np.empty_like(ids)
            above[np.flatnonzero(~bit)] = ids[: self.zeros[level]]
            above[np.flatnonzero(bit)] = ids[self.zeros[level] :] | ids.dtype.type(1 << (len(self.zeros) - 1 - level))
            ids = above
        return ids


def narrow(ids: np.ndarray, bits: int) -> np.ndarray:
    return ids.astype(np.uint16 if bits <= 16 else np.uint32)


def of_row(row) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["zeros"], row["planes"], row["ones_before"])


def shards(docs: DataFrame, vocabulary: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per shard (``SHARD_SCHEMA``); (part, shard) is the order of the ids.

    Each text is encoded whole and followed by ``END_ID``; null and empty texts are the end id
    alone. Rows with the same doc_id stay rows of their own, ordered by text; a null doc_id comes
    first. No rows give no shards. Other columns are not read.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def closed(part: int, shard: int, doc_ids: list, found: list[bytes]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(found), "<u4")
        matrix = WaveletMatrix.build(ids)
        columns = [
            pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([[len(f) // 4 for f in found]], pa.list_(pa.int64())),
            pa.array([matrix.zeros], pa.list_(pa.int64())),
            pa.array([[p.tobytes() for p in matrix.planes]], pa.list_(pa.binary())),
            pa.array([[b.tobytes() for b in matrix.before]], pa.list_(pa.binary())),
        ]
        names = ["part", "shard", "n_tokens", "doc_ids", "lengths", "zeros", "planes", "ones_before"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = library_encoder(path), np.array([END_ID], "<u4").tobytes()
        part, shard, held = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        found: list[bytes] = []
        for whole in batches:
            for batch in slices(whole, "text"):
                encoded = encoder.many(batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    doc_ids.append(doc_id)
                    found.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= shard_tokens:
                        yield closed(part, shard, doc_ids, found)
                        shard, held, doc_ids, found = shard + 1, 0, [], []
        if doc_ids:
            yield closed(part, shard, doc_ids, found)

    return ordered.mapInArrow(run, SHARD_SCHEMA)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    (
        shards(docs, **options)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 1)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def read_documents(stored: DataFrame) -> DataFrame:
    """part, shard, doc_id, place (ids before it in its shard), n_tokens, ids (little-endian 32-bit
    integers) of every document in written shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                raw = of_row(row).all().astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - row["lengths"]
                size = len(row["doc_ids"])
                ids = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * size, pa.int32()), pa.array([row["shard"]] * size, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "shard", "doc_id", "place", "n_tokens", "ids"],
                )

    return stored.mapInArrow(run, "part int, shard int, doc_id long, place long, n_tokens long, ids binary")


def first_places(stored: DataFrame) -> DataFrame:
    """part, shard, before: the ids of all shards before one, from one small row per shard."""
    before = F.sum("n_tokens").over(Window.orderBy("part", "shard")) - F.col("n_tokens")
    return stored.select("part", "shard", "n_tokens").select("part", "shard", before.alias("before"))


def occurrences(stored: DataFrame, token: int) -> DataFrame:
    """doc_id and position in the document of every occurrence of an id, by count and select."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = of_row(row)
                places = np.array([matrix.select(token, n) for n in range(matrix.count(token))], np.int64)
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                at = np.searchsorted(ends, places, side="right")
                doc_ids = np.array(row["doc_ids"], object)[at]
                starts = (ends - row["lengths"])[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids.tolist(), pa.int64()), pa.array(places - starts, pa.int64())],
                    ["doc_id", "position"],
                )

    return stored.mapInArrow(run, "doc_id long, position long")
