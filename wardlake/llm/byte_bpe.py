"""Byte-level BPE of a rank file as a reduction over a tree of text parts, and back.

The ids of a text form a monoid under a join that mends the seam. A text is halved until its parts
are short; parts are encoded, and neighbours are joined: around their seam a window grows until it
starts and ends at a safe space (see ``encoding``). Whatever stands before or after such a place is
encoded the same with or without what lies beyond it, so the tokens outside the window stay and
only the window is encoded again. A seam without any safe space grows to both whole parts. Decoding
puts together the bytes of token runs up the same kind of tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from wardlake.llm.base import texts
from wardlake.llm.encoding import SAFE, Encoder, rank_encoder, rank_table, slices

RANKS = "byte_bpe_multi_50k.tiktoken"
LEAF_CHARS = 2048
LEAF_TOKENS = 4096
FIRST_WINDOW = 32


def last_safe(text: str) -> int:
    """Place of the last safe space, or 0; looked for in windows that grow from the end."""
    width = FIRST_WINDOW
    while True:
        start = max(0, len(text) - width)
        places = [m.start() for m in SAFE.finditer(text, start)]
        if places or start == 0:
            return places[-1] if places else 0
        width *= 2


def first_safe(text: str) -> int:
    """Place of the first safe space, or the length."""
    found = SAFE.search(text)
    return found.start() if found else len(text)


def join(encoder: Encoder, left: tuple[str, bytes], right: tuple[str, bytes]) -> tuple[str, bytes]:
    """The node over two neighbours; a node is a text and its ids."""
    (a, a_ids), (b, b_ids) = left, right
    cut_a, cut_b = last_safe(a), first_safe(b)
    tail, head = a[cut_a:], b[:cut_b]
    old_tail, old_head = encoder.whole(tail), encoder.whole(head)
    seam = encoder.whole(tail + head)
    return a + b, a_ids[: len(a_ids) - len(old_tail)] + seam + b_ids[len(old_head) :]


def halves(text: str, leaf: int) -> list[str]:
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def encode_texts(encoder: Encoder, batch: list[str], leaf: int = LEAF_CHARS) -> list[bytes]:
    """Ids of each text; the leaves of all texts are encoded together, then joined level by level."""
    parts = [halves(text, leaf) for text in batch]
    flat = iter(encoder.many([part for leaves in parts for part in leaves]))
    out = []
    for leaves in parts:
        nodes = [(leaf_text, next(flat)) for leaf_text in leaves]
        # Halving by length gives all leaves of a text the same depth or one less: neighbours pair up.
        while len(nodes) > 1:
            pairs = zip(nodes[::2], nodes[1::2], strict=False)
            odd = nodes[-1:] if len(nodes) % 2 else []
            nodes = [join(encoder, *pair) for pair in pairs] + odd
        out.append(nodes[0][1])
    return out


def decode_ids(tokens: list[bytes], ids: list[int], leaf: int = LEAF_TOKENS) -> bytes:
    if len(ids) <= leaf:
        return b"".join(map(tokens.__getitem__, ids))
    middle = len(ids) // 2
    return decode_ids(tokens, ids[:middle], leaf) + decode_ids(tokens, ids[middle:], leaf)


def encode(docs: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids (array of int) of every row's whole text.

    Null and empty texts give no ids; repeated rows give repeated rows, a null doc_id stays null, no
    rows give none; other columns are not read. ``ranks`` is a path that every task can read.
    """
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                found = encode_texts(encoder, batch.column("text").to_pylist())
                ends = np.cumsum([0, *(len(ids) // 4 for ids in found)])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<u4").astype("i4"))
                )
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of ids; null ids count as none."""
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokens = rank_table(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [decode_ids(tokens, ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(found, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
