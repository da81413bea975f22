import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wardlake.llm import toxicity as tox
from wardlake.llm.queries import op9_toxicity


def test_terms_are_words_and_their_beginnings():
    column = pa.array(["Idiot, idiot! the", "", "idiots", "The"], pa.string())
    a, empty, b, c = (set(t.tolist()) for t in tox.terms_of(column))
    assert len(a) == 6 and not empty  # a word and its beginnings are terms apart
    assert len(a & b) == 2 and len(a & c) == len(b) == 3
    among = np.sort(np.array(list(a), np.uint64))
    assert [set(t.tolist()) for t in tox.terms_of(column, among)] == [a, set(), a & b, a & c]
    assert [len(t) for t in tox.terms_of(column, np.zeros(0, np.uint64))] == [0] * 4


def test_margin_against_all_pairs():
    rng = np.random.default_rng(1)
    machine = tox.Machine(np.arange(9).astype(np.uint64), 0.3, rng.normal(size=9), rng.normal(size=(9, tox.FACTORS)))
    found = [np.array(x, np.uint64) for x in ([0, 3, 8], [], [5], [1, 2, 3, 4])]
    for terms, score in zip(found, machine.scores(found), strict=True):
        at = terms.astype(int)
        pairs = sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(at) for j in at[n + 1 :])
        assert np.isclose(score, 1 / (1 + np.exp(-(0.3 + machine.weights[at].sum() + pairs))))


def test_learns_that_only_the_pair_is_toxic():
    terms = np.arange(2).astype(np.uint64)
    found = [terms[[]], terms[:1], terms[1:], terms] * 30
    labels = np.array([0, 0, 0, 1] * 30, float)
    machine = tox.fit(terms, found, labels)
    assert ((machine.scores(found) > 0.5) == labels).all()


def test_slopes_lower_the_loss_and_no_rows_are_fine():
    machine = tox.fit(np.zeros(0, np.uint64), [], np.zeros(0))
    assert machine.scores([np.zeros(0, np.uint64)]).tolist() == [0.5] and machine.scores([]).tolist() == []


def test_odd_rows(frame):
    text = "you idiot there"
    docs = frame(
        [(i, text if i % 3 == 0 else "calm words here", "z") for i in range(90)]
        + [(500, None, None), (501, "", None), (None, text, None), (0, text, None), (502, "idiot " * 20000, None)],
        "doc_id int, text string, score string",
    )
    labels = frame([(i, int(i % 3 == 0), None) for i in range(90)] + [(3, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == 95
    by_id = {r.doc_id: r for r in rows}
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(by_id[i].predicted == (i % 3 == 0) for i in range(90))
    assert by_id[502].predicted == by_id[None].predicted == 1
    assert by_id[500].predicted == by_id[501].predicted == 0 and by_id[500].score == by_id[501].score
    assert tox.toxicity(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert tox.toxicity(docs.limit(0), labels).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = op9_toxicity(spark, folder).where("held_out").join(known, "doc_id")
    wrong = rows.where(F.col("predicted") != F.col("toxic")).count()
    assert wrong <= 0.06 * rows.count()
    assert rows.where("predicted = 1 and toxic = 0").count() <= 1
