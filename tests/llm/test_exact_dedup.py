import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from wardlake.llm import exact_dedup as ed


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "x" * 50_000), (7, "x" * 50_000), (8, "é"), (None, "a"),
        (None, "only null"), (9, "b"), (9, "b"), (10, "a ")]


def test_rows_against_plain_groups(frame):
    docs = frame([(d, t, "s") for d, t in ROWS], "doc_id int, text string, digest string").repartition(3)
    assert result(ed.exact_duplicates(docs)) == expected(ROWS)
    assert ed.exact_duplicates(docs.limit(0)).count() == 0


def test_colliding_digests_are_taken_apart_by_full_texts(frame):
    """A digest of one hex digit puts different texts in one entry; the result is the same."""
    rows = [(i, f"text {i % 40}") for i in range(120)] + ROWS
    docs = frame(rows, "doc_id int, text string")
    weak = ed.exact_duplicates(docs, digest=lambda text: F.substring(F.unhex(F.sha2(text, 256)), 1, 1).cast("binary"))
    assert result(weak) == expected(rows)


def test_state_outlives_a_run_and_never_expires(spark, frame, tmp_path):
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    frame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(path)
    ed.update_state(ed.open_stream(spark, path), checkpoint)
    frame([(7, "a"), (8, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    state = ed.update_state(ed.open_stream(spark, path), checkpoint)
    found = {bytes(r.digest): (r.keep_id, r.group_size) for r in state.collect()}
    assert found == {hashlib.sha256(t).digest(): v for t, v in ((b"a", (7, 2)), (b"b", (2, 1)), (b"c", (8, 1)))}
    assert all(path in r.locator for r in state.select("locator").collect())


def test_later_runs_meet_the_keepers_of_earlier_ones(spark, frame, tmp_path):
    """A digest of one byte, so that new texts share entries with other texts of the first run."""
    def weak(text):
        return F.substring(F.unhex(F.sha2(text, 256)), 1, 1).cast("binary")

    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")

    def run(rows):
        docs = frame(rows, "doc_id long, text string")
        docs.write.mode("append").parquet(path)
        return ed.exact_duplicates(docs, ed.open_stream(spark, path), checkpoint, weak).collect()

    run([(i, f"first {i}") for i in range(300)])
    new = run([(1000 + i, f"second {i}") for i in range(50)])
    assert len(new) == 50 and all(r.kept and r.keep_id == r.doc_id for r in new)

    path, exact = str(tmp_path / "other"), str(tmp_path / "exact")
    frame([(i, f"first {i}") for i in range(20)], "doc_id long, text string").write.parquet(path)
    ed.update_state(ed.open_stream(spark, path), exact)
    again = frame([(5, "first 7"), (6, "new")], "doc_id long, text string")
    again.write.mode("append").parquet(path)
    found = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in ed.exact_duplicates(again, ed.open_stream(spark, path), exact).collect()}
    assert found == {5: (7, False, 2), 6: (6, True, 1)}


def test_plans_run_no_python(frame):
    docs = frame(ROWS, "doc_id int, text string")
    plan = ed.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
