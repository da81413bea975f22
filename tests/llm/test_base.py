import os
import tempfile
import time
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from wardlake.llm.base import ARROW_BYTES, BATCH_BYTES, DROP_SHUFFLES, written


def shuffle_files():
    local = Path(os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()))
    return {f for top in local.glob("blockmgr-*") for f in top.glob("*/shuffle_*.data")}


def test_shuffles_of_a_written_table_go_when_it_is_written(spark):
    kept, before = shuffle_files(), spark.conf.get(DROP_SHUFFLES)
    found = written(spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).count(), "counts")
    for _ in range(100):
        if not shuffle_files() - kept:
            break
        time.sleep(0.1)
    assert not shuffle_files() - kept
    assert found.count() == 7_000 and found.agg(F.sum("count")).first()[0] == 20_000
    assert spark.conf.get(DROP_SHUFFLES) == before


def test_batches_of_a_written_table_are_bounded_in_bytes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    before = spark.conf.get(ARROW_BYTES)
    rows = spark.range(0, 9_000, 1, 1).select(F.expr("repeat('x', 4000)").alias("text"))
    sizes = [r.n for r in written(rows.mapInArrow(run, "n long"), "sizes").collect()]
    assert sum(sizes) == 9_000 and max(sizes) <= 1.1 * BATCH_BYTES / 4000
    assert spark.conf.get(ARROW_BYTES) == before
