"""Scores of a maximum-entropy language model over hashed features, with class-factored softmax.

``P(word | history) = P(class | history) * P(word | class)``. The most frequent words have a class each;
any other word falls, by a hash of its last two bytes, into one of the remaining classes, known or not.
P(class | history) is a softmax over the sum of weights of four features: the previous word (hashed), the
word before it (hashed, skipping one), the classes of the previous two words, and those of
the two before them. P(word | class) is (c + 1) / (N_k + V_k + 1) from the class's training tokens and
types; the one left over is what all words unknown in the class share, as in the unigram base.

1. Tasks cut the documents into chunks of bounded size and write each as a row: the words of the
   chunk as 64-bit hashes, and its documents as numbers of those words.
2. Words are counted over all chunks by a shuffle of one row per chunk and word.
3. Every task makes gradient steps over its chunks from the common weights; their moves, summed in
   a tree, give the next weights. The move of a feature is the mean over the tokens that have it, so that
   tasks without it take nothing from it. Every training token takes part, in every round.
4. The counts of its words go back to each chunk, which scores its documents in sparse batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.llm.base import fold, texts, written
from wardlake.llm.encoding import slices
from wardlake.llm.hashing import Words, column_bytes, mixed
from wardlake.session import run_folder

CHUNK_BYTES = 12 << 20
#: Classes: 0 stands before a text; then the end, frequent words, and endings of words.
CLASSES = 64
FREQUENT = 15
FIRST_ENDING = 2 + FREQUENT
HASHED = 1 << 12
PAIRS = CLASSES * CLASSES
FEATURES = 2 * HASHED + 2 * PAIRS
ROUNDS = 2
STEP_TOKENS = 2048
BATCH_TOKENS = 4_096
#: Tokens of a step beyond which a feature's slopes are summed by themselves.
MANY_TOKENS = 20
#: Features that are moved at once: their rows stay in a core's cache.
UPDATE_ROWS = 512
BLOCK_ROWS = 256
FAN_IN = 64
_U = np.uint64
END = int(mixed(np.array([1], _U), 77)[0])

CHUNK_SCHEMA = (
    "chunk long, doc_ids array<long>, held_out array<boolean>, lengths array<long>, ids binary,"
    " words array<long>, endings array<tinyint>, counts array<long>"
)


def chunks(docs: DataFrame) -> DataFrame:
    """Rows of ``CHUNK_SCHEMA``: words by number (``words``, most frequent first), how often each is in
    training documents (``counts``), and the documents' tokens as such numbers (``ids``, compressed)."""

    def closed(chunk: int, doc_ids, held, lengths, hashes, endings) -> pa.RecordBatch:
        flat, last = np.concatenate(hashes), np.concatenate(endings)
        words, first, ids, n = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        ids = rank[ids].astype("<u4")
        learned = np.repeat(~np.array(held, bool), lengths)
        counts = np.bincount(ids[learned], minlength=len(words))
        columns = [
            pa.array([chunk]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
            pa.array([lengths], pa.list_(pa.int64())), pa.array([zlib.compress(ids.tobytes(), 1)], pa.binary()),
            pa.array([words[order].view(np.int64)], pa.list_(pa.int64())),
            pa.array([last[first][order].view(np.int8)], pa.list_(pa.int8())), pa.array([counts], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(
            columns, ["chunk", "doc_ids", "held_out", "lengths", "ids", "words", "endings", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, parts = TaskContext.get().partitionId() << 32, 0, ([], [], [], [], [])
        end = np.array([END], _U)
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = column_bytes(batch.column("text"))
                words = Words(data, offsets)
                hashes = words.hashes()
                tail = data[words.ends - 1].astype(_U) << _U(8) | data[np.maximum(words.ends - 2, words.starts)]
                endings = (FIRST_ENDING + mixed(tail, 5) % _U(CLASSES - FIRST_ENDING)).astype(np.uint8)
                places = words.first[1:]
                hashes = np.insert(hashes, places, end)
                endings = np.insert(endings, places, np.uint8(1))
                parts[0].extend(batch.column("doc_id").to_pylist())
                parts[1].extend(batch.column("held_out").to_pylist())
                parts[2].extend((np.diff(words.first) + 1).tolist())
                parts[3].append(hashes)
                parts[4].append(endings)
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield closed(chunk, *parts)
                    chunk, size, parts = chunk + 1, 0, ([], [], [], [], [])
        if parts[0]:
            yield closed(chunk, *parts)

    return texts(docs, (fold(7) == 2).alias("held_out")).mapInArrow(run, CHUNK_SCHEMA)


@dataclass
class Chunk:
    """A chunk's tokens with their hashes and classes."""

    lengths: np.ndarray
    held_out: np.ndarray
    ids: np.ndarray
    words: np.ndarray
    classes: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, at: int, frequent: np.ndarray) -> Chunk:
        row = {n: batch.column(n)[at] for n in ("lengths", "held_out", "ids", "words", "endings")}
        words = np.array(row["words"].values.to_numpy()).view(_U)
        classes = row["endings"].values.to_numpy().astype(np.int64)
        order = np.argsort(frequent)
        place = np.searchsorted(frequent[order], words)
        if len(frequent):
            hit = frequent[order][np.minimum(place, len(frequent) - 1)] == words
            classes[hit] = 2 + order[place[hit]]
        return cls(
            np.array(row["lengths"].values.to_numpy()),
            np.array(row["held_out"].values.to_numpy(zero_copy_only=False), bool),
            np.frombuffer(zlib.decompress(row["ids"].as_py()), "<u4").astype(np.int64),
            words,
            classes,
        )

    def features(self) -> np.ndarray:
        """(token, 4): rows of the weights."""
        place = np.arange(len(self.ids)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        kinds, hashes = self.classes[self.ids], (mixed(self.words, 6) % _U(HASHED)).astype(np.int64)[self.ids]

        def back(values: np.ndarray, n: int) -> np.ndarray:
            out = np.zeros_like(values)
            out[n:] = values[:-n] if n <= len(values) else 0
            out[place < n] = 0
            return out

        return np.stack(
            [
                back(hashes, 1),
                HASHED + back(hashes, 2),
                2 * HASHED + back(kinds, 1) * CLASSES + back(kinds, 2),
                2 * HASHED + PAIRS + back(kinds, 3) * CLASSES + back(kinds, 4),
            ],
            1,
        )


def class_odds(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Unnormalised probabilities of the classes for a batch of feature rows; class 0 has none."""
    sums = weights.take(rows[:, 0], 0)
    for feature in range(1, rows.shape[1]):
        sums += weights.take(rows[:, feature], 0)
    sums[:, 0] = -np.inf
    sums -= sums.max(1, keepdims=True)
    return np.exp(sums, out=sums)


def class_logs(weights: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Log probability of one class for each feature row."""
    odds = class_odds(weights, rows)
    return np.log(odds[np.arange(len(kinds)), kinds] / odds.sum(1))


def slope_sums(error: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features in ``rows``, and for each the sum of ``error`` over its tokens: feature by feature if it has many, else the
    nth tokens of all features at once."""
    flat = rows.T.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    flat, token = flat[order], order % len(rows)
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    sizes = np.diff(np.append(starts, len(flat)))
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    sums = error.take(token[starts], 0)
    many = int((sizes > MANY_TOKENS).sum())
    for at, (start, size) in enumerate(zip(starts[:many].tolist(), sizes[:many].tolist(), strict=True)):
        sums[at] = error.take(token[start : start + size], 0).sum(0)
    # Sizes fall, so features with an nth token come before the others.
    ends = np.searchsorted(-sizes, -np.arange(1, MANY_TOKENS))
    for nth, end in enumerate(ends.tolist(), 1):
        sums[many:end] += error.take(token[starts[many:end] + nth], 0)
    return flat[starts].astype(np.int64), sums


def steps(weights: np.ndarray, slopes: np.ndarray, rows: np.ndarray, kinds: np.ndarray) -> None:
    """Gradient steps over tokens, in place, scaled by the squares of earlier slopes."""
    for at in range(0, len(kinds), STEP_TOKENS):
        some, want = rows[at : at + STEP_TOKENS], kinds[at : at + STEP_TOKENS]
        error = class_odds(weights, some)
        error /= error.sum(1, keepdims=True)
        error[np.arange(len(want)), want] -= 1
        features, sums = slope_sums(error, some)
        for first in range(0, len(features), UPDATE_ROWS):
            touched, slope = features[first : first + UPDATE_ROWS], sums[first : first + UPDATE_ROWS]
            squares = slope * slope
            squares += slopes.take(touched, 0)
            slopes[touched] = squares
            np.sqrt(squares, out=squares)
            squares += 1.0
            slope *= 0.15
            slope /= squares
            weights[touched] -= slope


def trained(corpus: DataFrame, frequent: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after ``rounds`` passes over all training tokens."""
    spark = corpus.sparkSession
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    blocks = FEATURES // BLOCK_ROWS
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, slopes, tokens = shared.value.copy(), np.zeros_like(shared.value), np.zeros(FEATURES, np.int64)
            for batch in batches:
                for at in range(batch.num_rows):
                    chunk = Chunk.of(batch, at, frequent)
                    use = np.repeat(~chunk.held_out, chunk.lengths)
                    if use.any():
                        rows = chunk.features()[use]
                        steps(own, slopes, rows, chunk.classes[chunk.ids][use])
                        tokens += np.bincount(rows.ravel(), minlength=FEATURES)
            if tokens.any():
                move = ((own - shared.value) * tokens[:, None]).reshape(blocks, -1).astype("<f4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(blocks), pa.int32()), pa.array([TaskContext.get().partitionId()] * blocks, pa.int64()),
                        pa.array([n.tobytes() for n in tokens.reshape(blocks, -1).astype("<i8")], pa.binary()),
                        pa.array([m.tobytes() for m in move], pa.binary()),
                    ],
                    ["block", "part", "tokens", "move"],
                )

        def add(table: pa.Table) -> pa.Table:
            moves = np.stack([np.frombuffer(m, "<f4") for m in table.column("move").to_pylist()])
            tokens = np.stack([np.frombuffer(n, "<i8") for n in table.column("tokens").to_pylist()])
            return pa.table(
                {
                    "block": table.column("block")[:1], "part": pa.array([table.column("part")[0].as_py()], pa.int64()),
                    "tokens": pa.array([tokens.sum(0).tobytes()], pa.binary()),
                    "move": pa.array([moves.sum(0).tobytes()], pa.binary()),
                }
            )

        schema = "block int, part long, tokens binary, move binary"
        moves = corpus.mapInArrow(run, schema)
        parts = corpus.rdd.getNumPartitions()
        while parts > 1:
            # At most FAN_IN moves of a block meet in a group.
            moves = moves.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("block", "part").applyInArrow(add, schema)
            parts = -(-parts // FAN_IN)
        for r in moves.collect():
            at = r.block * BLOCK_ROWS
            tokens = np.maximum(np.frombuffer(r.tokens, "<i8"), 1)[:, None]
            weights[at : at + BLOCK_ROWS] += np.frombuffer(r.move, "<f4").reshape(BLOCK_ROWS, CLASSES) / tokens
        shared.unpersist()
    return weights


def scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of
    ``docs``.

    Tokens are the words, A-Z lower-cased, and one end; null and empty texts are the end alone.
    Repeated rows are counted and scored as often as they come; a null doc_id belongs to the fold of an
    empty text. If no document is in the training folds, every word is unknown. No rows give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark)
    corpus = written(chunks(docs), "chunks", folder)
    zipped = F.posexplode(F.arrays_zip("words", "counts", "endings")).alias("number", "entry")
    entries = corpus.select("chunk", zipped).select(
        "chunk", "number", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"), F.col("entry.endings").alias("ending")
    )
    # A word has one row per chunk, so its window has at most as many rows as there are chunks.
    of_word = Window.partitionBy("word")
    first = F.row_number().over(of_word.orderBy("chunk")) == 1
    counts = written(
        entries.select(
            "chunk",
            "number",
            F.sum("n").over(of_word).alias("n"),
            # The word and its ending stand in its first row only.
            F.when(first, F.col("word")).alias("word"),
            F.when(first, F.col("ending")).alias("ending"),
        ),
        "counts",
        folder,
    )
    words = counts.where("ending IS NOT NULL").select("word", "n", "ending")
    end = int(np.array([END], _U).view(np.int64)[0])
    top = words.where((F.col("n") > 0) & (F.col("word") != end)).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = np.array([r.word for r in top], np.int64).view(_U)
    weights = trained(corpus, frequent, rounds)
    tokens, types = class_totals(words, [r.word for r in top])
    back = counts.select(F.col("chunk").alias("of_chunk"), "number", "n")
    shared = spark.sparkContext.broadcast((weights, tokens, types))

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        weights, tokens, types = shared.value
        known = np.zeros(right.num_rows, np.int64)
        known[right.column("number").to_numpy()] = right.column("n").to_numpy()
        chunk = Chunk.of(left.combine_chunks(), 0, frequent)
        n, kinds, rows = known[chunk.ids], chunk.classes[chunk.ids], chunk.features()
        total, distinct = int(tokens.sum()), int(types.sum())
        logs = np.log10((n + 1) / (tokens[kinds] + types[kinds] + 1))
        for at in range(0, len(kinds), BATCH_TOKENS):
            some = kinds[at : at + BATCH_TOKENS]
            found = class_logs(weights, rows[at : at + BATCH_TOKENS], some)
            logs[at : at + len(some)] += found / np.log(10)
        base = np.log10((n + 1) / (total + distinct + 1))
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        return pa.table(
            {
                "doc_id": left.column("doc_ids")[0].values,
                "held_out": pa.array(chunk.held_out),
                "n_tokens": pa.array(chunk.lengths),
                "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(starts), total)),
                "base_score": pa.array(np.add.reduceat(base, starts)),
                "score": pa.array(np.add.reduceat(logs, starts)),
            }
        )

    return (
        corpus.groupBy("chunk")
        .cogroup(back.groupBy("of_chunk"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def class_totals(counts: DataFrame, frequent: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and types of every class."""
    kind = F.col("ending").cast("int")
    if frequent:
        own = F.create_map(*[F.lit(x) for place, word in enumerate(frequent) for x in (word, 2 + place)])
        kind = F.coalesce(F.element_at(own, F.col("word")), kind)
    tokens, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    known = counts.where("n > 0").groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))
    for r in known.collect():
        tokens[r.kind], types[r.kind] = r.n, r.types
    return tokens, types
