"""Command line: ``spark-submit -m`` style entry to the jobs of the pipeline."""

from __future__ import annotations

import argparse
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators.balls import BallIndex
from wardlake.operators.vectors import TOP_K
from wardlake.plans import metrics, reports, retrieval, semantic
from wardlake.plans.gold import MARTS
from wardlake.schemas import SOURCE_TABLES, SourceTable
from wardlake.session import build_session, run_folder
from wardlake.sources.changes import read_kafka, read_landing
from wardlake.sources.tables import TableNotFound, read_table, register_views
from wardlake.sources.versioned import CommittedTable
from wardlake.streaming.bronze import append_bronze, await_all, read_bronze, start_bronze, write_bronze_batches
from wardlake.streaming.listener import MetricsListener
from wardlake.streaming.pipeline import publish_gold, run_pipeline

# Metric rows that are written together while streams run.
METRIC_ROWS_PER_FILE = 500
NOTES = "clinical_notes"


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wardlake", description=__doc__)
    parser.add_argument("--base", required=True, help="folder of the layers, on shared storage")
    parser.add_argument("--master", default=None)
    jobs = parser.add_subparsers(dest="job", required=True)

    bronze = jobs.add_parser("bronze", help="change stream to Bronze")
    origin = bronze.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers", help="broker addresses")
    origin.add_argument("--landing", help="folder of JSON change records")
    bronze.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    bronze.add_argument(
        "--per-trigger", type=int, default=None,
        help="records (files of a landing folder) per topic; no limit when left out",
    )
    bronze.add_argument("--every", default=None, help="trigger interval; once when left out")
    bronze.add_argument("--batches", action="store_true", help="one directory per batch")

    run = jobs.add_parser("run", help="Silver, then Gold")
    run.add_argument("--silver-only", action="store_true")
    run.add_argument("--gold-only", action="store_true")
    run.add_argument("--as-of", default=None)
    run.add_argument("--keep", type=int, default=3, help="old commits to spare")

    report = jobs.add_parser("report", help="ready-made reports")
    report.add_argument("--table", action="append", help="a mart; all when left out")
    report.add_argument("--rows", type=int, default=None, help="rows shown; all when left out")

    jobs.add_parser("health", help="row counts and freshness")
    sql = jobs.add_parser("sql", help="one query over the marts and notes, as JSON")
    sql.add_argument("query")
    sql.add_argument("--rows", type=int, default=semantic.ANSWER_ROWS)

    jobs.add_parser("embed", help="vectors of the notes, stored")
    ask = jobs.add_parser("retrieve", help="notes and context of questions, as JSON")
    ask.add_argument("question", nargs="+")
    ask.add_argument("--hits", type=int, default=TOP_K)
    return parser


def landing_folder(landing: str, table: SourceTable) -> str:
    """A landing folder has a folder for each table, so that no stream reads the others' records."""
    return f"{landing.rstrip('/')}/{table.name}"


def embedded(spark: SparkSession, base: str) -> tuple[DataFrame, retrieval.Embedder]:
    """The notes below the base folder with their stored vectors, and the fitted weights."""
    model = retrieval.Embedder(read_table(spark, "weights", [f"{base}/retrieval"]), retrieval.DIMS)
    return read_table(spark, "notes", [f"{base}/retrieval"]), model


def store_cells(spark: SparkSession, base: str, notes: DataFrame) -> None:
    """The cells of the notes' vectors in a new folder, which counts once its name is published."""
    root = f"{base}/retrieval/cells-{uuid.uuid4().hex}"
    BallIndex(spark, root).build(notes)
    CommittedTable(spark, f"{base}/retrieval/cells").publish(spark.createDataFrame([(root,)], "root STRING"))


def stored_cells(spark: SparkSession, base: str) -> BallIndex | None:
    """The cells published last; none for vectors that were stored without."""
    published = CommittedTable(spark, f"{base}/retrieval/cells").read()
    return BallIndex(spark, published.first()["root"]) if published is not None else None


def main(argv: list[str] | None = None) -> int:
    given = arguments().parse_args(argv)
    spark = build_session(f"wardlake-{given.job}", given.master)
    base, gold = given.base.rstrip("/"), [f"{given.base.rstrip('/')}/gold"]

    if given.job == "bronze":
        listener = MetricsListener()
        spark.streams.addListener(listener)

        def source(table):
            if given.landing:
                return read_landing(spark, landing_folder(given.landing, table), [table.topic], given.per_trigger)
            limits = {"starting": given.starting, "records_per_trigger": given.per_trigger}
            return read_kafka(spark, given.servers, [table.topic], **limits)

        sink = write_bronze_batches if given.batches else append_bronze
        table = f"{base}/metrics/streaming"
        queries = start_bronze(source, base, every=given.every, start=sink)
        try:
            await_all(queries, lambda: listener.flush(spark, table, METRIC_ROWS_PER_FILE))
        finally:
            listener.wait_for_end(queries)
            spark.streams.removeListener(listener)
            listener.flush(spark, table)
    elif given.job == "run":
        if given.gold_only:
            publish_gold(spark, base, given.as_of, given.keep)
        else:
            run_pipeline(spark, base, given.as_of, given.silver_only, keep=given.keep)
    elif given.job == "report":
        run = reports.run_reports(lambda name: read_table(spark, name, gold), given.table)
        for name, frame in run.frames.items():
            print(name)
            # Reports are short by their own limits or groups; a cut is asked for, and shown as one.
            total = frame.count()
            frame.show(total if given.rows is None else given.rows, truncate=False)
            if given.rows is not None and total > given.rows:
                print(f"{given.rows} of {total} rows")
        for name, problem in run.problems.items():
            print(f"{name}: {problem}")
        return 1 if run.problems else 0
    elif given.job == "health":
        marts, logs = {}, {}
        for found, names, folder in ((marts, MARTS, gold[0]), (logs, SOURCE_TABLES, f"{base}/bronze")):
            for name in names:
                try:
                    found[name] = read_table(spark, name, [folder])
                    if found is logs:
                        logs[name] = read_bronze(spark, base, name)
                except TableNotFound as missing:
                    print(missing)
        if marts:
            health = metrics.layer_health(marts, logs)
            health.show(truncate=False)
            rows = metrics.as_metric_rows(health).coalesce(1)
            rows.write.mode("append").parquet(f"{base}/metrics/health")
        captured = [
            log.select(F.lit(SOURCE_TABLES[n].topic).alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
            for n, log in logs.items()
        ]
        log = reduce(DataFrame.unionByName, captured) if captured else None
        metrics.topic_health(log, [t.topic for t in SOURCE_TABLES.values()]).show(truncate=False)
    elif given.job == "sql":
        register_views(spark, MARTS, gold, semantic.describe)
        register_views(spark, [NOTES], [base], semantic.describe)
        print(json.dumps(semantic.run_sql(spark, given.query, given.rows), ensure_ascii=False))
    elif given.job == "embed":
        texts = retrieval.note_text(read_table(spark, NOTES, [base]))
        model = retrieval.fit_embedder(texts)
        CommittedTable(spark, f"{base}/retrieval/weights").publish(model.weights)
        CommittedTable(spark, f"{base}/retrieval/notes").publish(retrieval.embed(model, texts))
        store_cells(spark, base, embedded(spark, base)[0])
    elif given.job == "retrieve":
        notes, model = embedded(spark, base)
        asked = spark.createDataFrame(list(enumerate(given.question)), "query_id BIGINT, embed_text STRING")
        marts = [read_table(spark, name, gold) for name in ("patient_summary", "critical_alerts")]
        answer = retrieval.retrieve(notes, asked, model, *marts, run_folder(spark), given.hits, stored_cells(spark, base))
        for name, frame in answer.items():
            for line in frame.toJSON().toLocalIterator():
                print(json.dumps({"part": name} | json.loads(line), ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
