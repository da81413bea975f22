import re
from collections import Counter

from wardlake.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    spans = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(spans)
    covered = {p for i, s in enumerate(spans) if n[s] > 1 for p in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in qr.SYMBOLS),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_distinct_words": len(set(words)),
    }


TEXTS = [
    None, "", " \n\t", "word " * 7, "word " * 8, "word " * 9, "a b c d e f g h " * 2, "a b c d e f g h x a b c d e f g h y a b c d e f g",
    " ".join(f"w{i}" for i in range(500)), "line\nline\n\nline \n", "#*$%&|<>" * 10, "é😀 ü\x0bö\x1cx\xa0y", "THE END " * 30,
    " ".join(f"w{i}" for i in range(30)) + " " + " ".join(f"w{i}" for i in range(30)), "x " * 30_000, "a" * 5000,
]


def test_measurements_against_plain_python(frame):
    docs = frame([(i, t, "q") for i, t in enumerate(TEXTS)] + [(None, "a b", "q"), (3, TEXTS[3], "q")],
                 "doc_id int, text string, words string")
    rows = qr.ledger(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        measures = plain(TEXTS[row.doc_id] if row.doc_id is not None else "a b")
        assert {k: row[k] for k in measures} == measures, row.doc_id
    assert qr.ledger(docs.limit(0)).count() == 0


def test_bits_policies_and_ablations(frame):
    docs = frame(list(enumerate(TEXTS)), "doc_id int, text string")
    entries = qr.ledger(docs).cache()
    rows = entries.collect()
    for policy in qr.POLICIES:
        kept = {r.doc_id: r.kept for r in qr.apply_policy(entries, policy).collect()}
        assert kept == {r.doc_id: not any(r.failed & qr.bit(name) for name in policy.rules) for r in rows}
        found = {r.rule: (r.failing, r.failing_alone) for r in qr.ablations(entries, policy).collect()}
        for name in policy.rules:
            failing = [r for r in rows if r.failed & qr.bit(name)]
            alone = [r for r in failing if r.failed & policy.mask == qr.bit(name)]
            assert found.get(name, (0, 0)) == (len(failing), len(alone))
    few = {r.doc_id for r in rows if r.failed & qr.bit("few_words")}
    assert few == {i for i, t in enumerate(TEXTS) if plain(t)["n_words"] < 20}


def test_plan_runs_no_python_and_no_shuffle(frame):
    plan = qr.ledger(frame([(1, "a")], "doc_id int, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
