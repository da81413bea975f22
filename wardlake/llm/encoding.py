"""Token ids of whole texts inside tasks, by the public tokenizer libraries.

Most words of a corpus are repeats. A text is cut at safe spaces (below), and each distinct piece is
encoded once per worker by the library; a text that has other spaces, or the string of a token that the
library adds to its vocabulary, goes to the library whole.

A single space between two characters that are no white space, in any reading of white space, always
starts a match of the pattern that splits text before the merges, and nothing before that space
matters for what follows. Ids of the pieces, put together, are therefore the ids of the text.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Anything that some engine may take for white space.
BLANK = r"\s\x00-\x1f\x7f-\xa0\u180e\u200b-\u200f\u2060-\u2064\ufeff"
#: The same for Arrow, whose ``\s`` is ASCII's, and a space beside one of them or at an end of the text.
ARROW_BLANK = (
    r"\x00-\x20\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"
)
UNSAFE = rf" [{ARROW_BLANK}]|[{ARROW_BLANK}] |\A | \z"
SAFE = re.compile(rf"(?<=[^{BLANK}]) (?=[^{BLANK}])")
#: Bytes of pieces and their ids that a worker remembers; beyond them it forgets all and encodes some again. On 68 MB of
#: text, which need 280 MB, two generations of 30, 50 and 100 MB took 2.1, 1.6 and 1.35 times as long as no bound.
REMEMBERED = 192 << 20
#: Bytes that an entry takes beside its text and ids.
ENTRY = 190
LONGEST_PIECE = 200
#: After a letter, one of these that ends a piece is a match of its own.
STOPS = ",."
CHARS_PER_CALL = 40_000
CHARS_PER_BATCH = 1 << 20


class Encoder:
    """``encode`` takes a list of strings to lists of ids; ``spaced[id]`` tells whether the bytes of
    a token start with a space."""

    def __init__(self, encode, spaced: np.ndarray, added: Iterable[str] = ()):
        self.encode, self.spaced = encode, spaced
        self.added = tuple(added)
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.stops = {stop: self.whole(stop) for stop in STOPS}

    def whole(self, text: str) -> bytes:
        if not text:
            return b""
        return np.asarray(self.encode([text])[0], "<u4").tobytes()

    def learn(self, pieces: Iterable[str]) -> None:
        """Ids of pieces that each follow a space; words with a stop after them from the words."""
        known, stops, size = self.known, self.stops, len(self.known)
        plain, stopped = set(), []
        for piece in pieces:
            word = piece[:-1]
            if piece[-1] in STOPS and word.isalpha():
                stopped.append((piece, word))
                if word not in known:
                    plain.add(word)
            else:
                plain.add(piece)
        self.learn_plain(plain)
        known.update([(piece, known[word] + stops[piece[-1]]) for piece, word in stopped])
        self.held += (len(known) - size) * ENTRY + sum(map(len, plain)) * 2

    def learn_plain(self, pieces: Iterable[str]) -> None:
        """Ids of pieces that each follow a space: encoded together, and parted where a token starts
        with a space, which only a piece's first token does."""
        calls: list[list[str]] = []
        size = CHARS_PER_CALL + 1
        for piece in pieces:
            if size > CHARS_PER_CALL:
                calls.append([])
                size = 0
            calls[-1].append(piece)
            size += len(piece) + 1
        for call, ids in zip(calls, self.encode(["".join(f" {p}" for p in call) for call in calls]), strict=True):
            ids = np.asarray(ids, "<u4")
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) != len(call):
                raise ValueError("a piece does not start with a spaced token")
            ends = [*starts[1:].tolist(), len(ids)]
            raw = ids.tobytes()
            self.known.update(
                (piece, raw[4 * a : 4 * b]) for piece, a, b in zip(call, starts.tolist(), ends, strict=True)
            )

    def many(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        whole = pc.match_substring_regex(texts, UNSAFE)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        whole = whole.to_numpy(zero_copy_only=False).astype(bool)
        out: list = [None] * len(texts)
        cut = np.flatnonzero(~whole)
        if len(cut):
            for at, ids in zip(cut.tolist(), self.cut(texts.take(pa.array(cut))), strict=True):
                out[at] = ids
        for at in [i for i, ids in enumerate(out) if ids is None]:
            out[at] = self.whole(texts[at].as_py())
        return out

    def cut(self, texts: pa.Array) -> list[bytes | None]:
        """Ids of texts with safe spaces only, put together from those of the distinct pieces; None for a text with
        a piece that is too long to be remembered."""
        parts = pc.split_pattern(texts, " ")
        starts = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        pieces = parts.flatten().dictionary_encode()
        code = pieces.indices.to_numpy().astype(np.int64)
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        # The first piece of a text follows no space: it has an entry of its own behind the distinct ones.
        firsts = pc.list_element(parts, 0).to_pylist()
        code[starts] = len(distinct) + np.arange(len(firsts))
        entries = list(map(self.known.get, distinct))
        missed = [i for i, ids in enumerate(entries) if ids is None]
        long = np.zeros(len(distinct) + len(firsts), bool)
        if missed:
            spaced = np.zeros(len(long), bool)
            spaced[code] = True
            self.learn({distinct[i] for i in missed if spaced[i] and len(distinct[i]) <= LONGEST_PIECE})
            for i in missed:
                ids = self.known.get(distinct[i])
                long[i] = ids is None
                entries[i] = ids or b""
        entries += [self.whole(first) for first in firsts]
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        table = np.frombuffer(b"".join(entries), "<u4")
        count = size[code]
        ends = np.cumsum(count)
        raw = table[np.repeat((np.cumsum(size) - size)[code] - (ends - count), count) + np.arange(int(ends[-1]))].tobytes()
        last = ends[np.append(starts[1:], len(code)) - 1].tolist()
        refused = np.logical_or.reduceat(long[code], starts).tolist()
        return [None if no else raw[4 * a : 4 * b] for a, b, no in zip([0, *last[:-1]], last, refused, strict=True)]


@functools.lru_cache(maxsize=4)
def library_encoder(path: str) -> Encoder:
    """The encoder of a ``tokenizers`` file, as the library reads it: the string of an added token is that token."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    spaced = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, number in tokenizer.get_vocab().items():
        spaced[number] = token.startswith("Ġ")  # a space in the alphabet of byte-level files

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return Encoder(encode, spaced, [t.content for t in tokenizer.get_added_tokens_decoder().values()])


@functools.lru_cache(maxsize=4)
def rank_table(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """Ranks by token, and tokens by rank, of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


@functools.lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file whose pieces are the matches of ``pattern``."""
    import tiktoken

    ranks, tokens = rank_table(path)
    library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Encoder(
        lambda texts: [library.encode_ordinary(text) for text in texts],
        np.array([token.startswith(b" ") for token in tokens]),
    )


def slices(batch: pa.RecordBatch, size_of: str, most: int = CHARS_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """The batch in parts that hold about ``most`` bytes of a text or binary column."""
    column = batch.column(batch.schema.get_field_index(size_of))
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, len(sizes)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
