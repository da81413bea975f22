"""The pipeline against its stages worked out again by plain Python."""

from test_ngram_join import brute_force
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
import public_tokenizers
from wardlake.llm import language, packing, token_shards, toxicity

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_row_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    spoken = {r.doc_id for r in language.language_id(docs).collect() if r.lang_pred != "und" and r.score >= 0.5}
    left = {d: t for d, t in rows.items() if d in spoken}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    machine_docs = docs.where(docs.doc_id.isin(list(left)))
    calm = {r.doc_id for r in toxicity.toxicity(machine_docs, labels).collect() if not r.predicted}
    left = {d: t for d, t in left.items() if d in calm}
    last = {t: d for d, t in sorted(left.items())}
    left = {d: t for d, t in left.items() if last[t] == d}
    least = {d: c for d, _, c in brute_force(sorted(left.items()))}
    left = {d: t for d, t in left.items() if least[d] == d}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_shards.VOCABULARY))
    expected = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in left.items()}
    packed = pipeline.run(spark, FOLDER).collect()
    tokens: dict = {}
    for r in packed:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == expected and len(expected) > 100
    ends: dict = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= packing.WINDOW


def test_stages_keep_columns_rows_and_odd_documents(spark, frame):
    text = " ".join(f"word{i} the and" for i in range(30))
    near = text + " end"
    rows = [(1, text, "en", "s", 1), (2, text, "en", None, None), (3, near, None, "s", 3), (None, "an odd text of its own here", "en", "s", 4),
            (5, None, "en", "s", 5), (6, "", None, None, 6), (7, "12 34", "en", "s", 7), (8, "word " * 20_000, "en", "s", 8)]
    docs = frame([(*r, "more") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string")
    left = docs
    for name, stage in pipeline.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    ids = {r.doc_id for r in left.collect()}
    assert ids == {2, None, 8} or ids == {2, 8}  # 1 equals 2; 3 is near 2; 5 to 7 have no letter
    assert len(pipeline.STAGES) == 5


def test_rows_without_an_id_are_decided_one_by_one(spark, frame, tmp_path):
    toxic, clean = "you idiot there", "calm words here"
    frame([(i, int(i % 3 == 0), 1) for i in range(90)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(i, f"{toxic if i % 3 == 0 else clean} {i}") for i in range(90)]
    odd = [(None, clean), (None, toxic), (None, None), (None, clean), (201, clean + " end"), (201, toxic), (202, "own"), (202, "own"), (203, clean)]
    docs = frame([(*r, "en", "s", 1) for r in rows + odd], "doc_id long, text string, lang string, source string, n_chars long")
    calm = pipeline.toxic(spark, docs, str(tmp_path))
    assert calm.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in calm.collect() if r.doc_id is None or r.doc_id > 200) == sorted(
        (str(i), str(t)) for i, t in odd if t != toxic
    )
    left = [(r.doc_id, r.text) for r in pipeline.exact(spark, calm, str(tmp_path)).collect() if r.doc_id is None or r.doc_id > 200]
    assert sorted(left, key=str) == sorted([(None, None), (201, clean + " end"), (202, "own"), (203, clean)], key=str)


def test_a_run_without_rows(spark, frame, tmp_path):
    frame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    frame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
