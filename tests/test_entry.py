"""The driver's entry module in a copy of the repository without the corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as e
names = set(e.queries())
assert "pipeline" not in names and not [n for n in names if n.startswith("op")]
assert set(e.oracle_sql()) <= names and "gold_patient_summary" in names
"""


def test_imports_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    open(copy / "corpus_pipeline.py", "a").close()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
