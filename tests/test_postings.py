"""Search through posting lists against a look at every text."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from wardlake.operators import postings
from wardlake.operators.postings import TextIndex, grams

TEXTS = [
    None, "", "a", "ab", "abc", "ABC abc", "the license of the cat", "LICENSE", "licen se", "nselice", "aaaa", "naïve Ärzte 🎉🎉 end",
    "100% _sure_ \\ [x]", "line\nbreak", "x" * 3_000 + "license", "lic cen ice ens nse",
]
SCHEMA = "note_id int, note_text string, other string"


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(5)
    more = ["".join(r.choice("abcÄ ") for _ in range(r.randrange(40))) for _ in range(150)]
    rows = [(n * 7 - 50, text, "z") for n, text in enumerate(TEXTS + more)]
    patch = pytest.MonkeyPatch()
    patch.setattr(postings, "BLOCK_BITS", 6)
    patch.setattr(postings, "SHARDS", 8)
    made = TextIndex(spark, str(tmp_path_factory.mktemp("index")), "note_id", "note_text")
    made.build(spark.createDataFrame(rows, SCHEMA))
    yield made, rows
    patch.undo()


@pytest.mark.parametrize("word", ["license", "LiCense", "abc", "ab", "", "aaaa", "ärzte", "🎉🎉 ", "% _", "\\ [", "e\nb", "c a", "nowhere", "abcabcabc"])
def test_rows_equal_a_scan(index, word):
    made, rows = index
    found = sorted((r.note_id, r.note_text, r.other) for r in made.search(word).collect())
    assert found == sorted(r for r in rows if r[1] is not None and word.lower() in r[1].lower())


def test_lists_are_bounded_and_read_by_shard(index):
    made, rows = index
    stored = made.spark.read.parquet(f"{made.root}/postings")
    widest = stored.agg(F.max(F.size("ids"))).first()[0]
    assert widest <= 1 << postings.BLOCK_BITS
    assert stored.groupBy("gram", "block").count().where("count > 1").count() == 0
    opened = made.lists(["lic", "ice"]).inputFiles()
    plan = made.lists(["lic"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [shard" in plan
    assert len(opened) <= len(glob.glob(f"{made.root}/postings/shard=*/*.parquet"))


def test_no_rows(spark, tmp_path):
    made = TextIndex(spark, str(tmp_path / "none"), "note_id", "note_text")
    made.build(spark.createDataFrame([], SCHEMA))
    assert made.search("license").count() == made.search("x").count() == 0


def test_trigrams_are_distinct_and_whole(spark):
    frame = spark.createDataFrame([("abcabc",), ("ab",), (None,), ("🎉é1",)], "t string")
    assert [sorted(r[0]) for r in frame.select(grams(F.col("t"))).collect()] == [["abc", "bca", "cab"], [], [], ["🎉é1"]]
