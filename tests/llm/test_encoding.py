import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardlake.llm import byte_bpe, encoding, packing, token_shards

FILE = public_tokenizers.path(token_shards.VOCABULARY)
RANKS = public_tokenizers.path(byte_bpe.RANKS)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "it's we'll  they're\n\n x", "\tx y", "été naïve — 12 34", "a  b",
    "日本語 テキスト", "x᠎ y", "<|endoftext|> and <|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>", "<|endoftext|>", "a <|endoftext| > b",
    "a\x1c b", "'re 're", "x" * 500 + " " + "y z " * 900,
    "\n \n word.\nNext line", "emoji 🎉🎉 end", "é combining", "a\r\n b \r\n",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranked():
    ranks, _ = encoding.rank_table(RANKS)
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_whole_texts_as_the_libraries_encode_them(library, ranked):
    assert [ids_of(x) for x in encoding.library_encoder(FILE).many(ODD)] == [library(t) for t in ODD]
    encoder = encoding.rank_encoder(RANKS, public_tokenizers.PATTERN)
    assert [ids_of(x) for x in encoder.many(ODD)] == [ranked.encode_ordinary(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sre1 \n\té !🎉"), max_size=60))
def test_tree_of_small_leaves_and_round_trip(ranked, text):
    encoder = encoding.rank_encoder(RANKS, public_tokenizers.PATTERN)
    ids = ids_of(byte_bpe.encode_texts(encoder, [text], leaf=5)[0])
    assert ids == ranked.encode_ordinary(text)
    _, tokens = encoding.rank_table(RANKS)
    assert byte_bpe.decode_ids(tokens, ids, leaf=3) == text.encode()


def test_bounded_memory_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 300)
    encoder = encoding.library_encoder(FILE)
    for text in ("one two three four five", "six seven one two"):
        assert ids_of(encoder.many([text])[0]) == library(text)


ROWS = [(5, "b a b", "x"), (None, None, "y"), (2, "", "z"), (5, "b a b", None), (9, "word " * 3000, "w"), (7, None, None)]


def test_encode_and_decode_rows(frame, ranked):
    docs = frame(ROWS, "doc_id int, text string, ids string")
    rows = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    expected = [(i, ranked.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in ROWS]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in rows), key=str) == sorted(expected, key=str)
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0))).count() == 0


def test_wavelet_matrix_against_a_list():
    rng = np.random.default_rng(1)
    for size in (0, 1, 511, 512, 1025, 3000):
        ids = rng.integers(0, 300, size).astype(np.uint32)
        matrix = token_shards.WaveletMatrix.build(ids)
        assert matrix.all().tolist() == ids.tolist()
        for at in rng.integers(0, size, 20).tolist() if size else []:
            assert matrix.access(at) == ids[at]
            token = int(ids[at])
            assert matrix.count(token, at) == int((ids[:at] == token).sum())
            assert matrix.select(token, matrix.count(token, at)) == at
        assert matrix.count(100_000) == 0 and matrix.count(301) == 0
        with pytest.raises(IndexError):
            matrix.select(299, size)


def test_shards_round_trip(spark, frame, library, tmp_path):
    docs = frame(ROWS, "doc_id int, text string, n_tokens string")
    token_shards.write_shards(docs, str(tmp_path / "s"), shard_tokens=5)
    stored = token_shards.read_shards(spark, str(tmp_path / "s"))
    assert stored.count() == len(list((tmp_path / "s").glob("part-*"))) > 1
    before = {(r.part, r.shard): r.before for r in token_shards.first_places(stored).collect()}
    found = sorted(
        (before[r.part, r.shard] + r.place, r.doc_id, ids_of(r.ids))
        for r in token_shards.read_documents(stored).collect()
    )
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(d, ids) for _, d, ids in found] == [(i, [*library(t or ""), 0]) for i, t, _ in ordered]
    assert [s for s, _, _ in found] == np.cumsum([0, *(len(ids) for _, _, ids in found[:-1])]).tolist()
    token = library("a b a b")[1]
    hits = token_shards.occurrences(stored, token).collect()
    assert sorted((h.doc_id, h.position) for h in hits) == sorted(
        (d, p) for _, d, ids in found for p, i in enumerate(ids) if i == token
    )
    token_shards.write_shards(docs.limit(0), str(tmp_path / "none"))
    assert token_shards.read_shards(spark, str(tmp_path / "none")).count() == 0


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 33, 400).tolist()
    windows, offsets = packing.best_fit(lengths, 32)
    room: list[int] = []
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[at]]
        if fits:
            assert 32 - offsets[at] == min(fits) == room[windows[at]]
            room[windows[at]] -= lengths[at]
        else:
            assert windows[at] == len(room)
            room.append(32 - lengths[at])


def test_packing_keeps_every_id_once(frame, library):
    docs = frame(
                 ROWS + [(i, "some words here " * (i % 90), None) for i in range(100, 400)],
                 "doc_id int, text string, length string")
    cut = packing.pieces(docs)
    packed = packing.pack(cut, group=64).collect()
    by_sequence, by_document = {}, {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_document.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    for held in by_sequence.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held[:-1])]).tolist()
        assert sum(n for _, n in held) <= packing.WINDOW
    for doc_id, text, _ in ROWS:
        if doc_id != 5:
            found = sorted(by_document[doc_id])
            assert ids_of(b"".join(ids for _, _, ids, _ in found)) == [*library(text or ""), 0]
    assert sorted(by_document[5])[0] == sorted(by_document[5])[1]
    total = sum(r.length for r in packed)
    assert len(by_sequence) * packing.WINDOW < 1.05 * total + 6 * packing.WINDOW
    sequences = packing.packed_sequences(packing.pack(cut)).collect()
    assert sum(len(s.ids) for s in sequences) == 4 * total
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_queries_against_the_libraries(spark, library, ranked):
    from wardlake.llm.queries import op5_token_shards, op6_byte_bpe, op10_packing

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, shards, bpe, pack = 0, [], [], {}
    for doc_id, text in rows:
        ids = [*library(text or ""), 0]
        shards.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        pack[doc_id] = ids
        own = ranked.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        bpe.append((doc_id, len(own), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, op5_token_shards(spark, folder).collect())) == shards
    assert sorted(map(tuple, op6_byte_bpe(spark, folder).collect())) == bpe
    for r in op10_packing(spark, folder).collect():
        piece = pack[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and r.doc_tokens == len(pack[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
    assert op10_packing(spark, folder).agg(F.sum("length")).first()[0] == start
