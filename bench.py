"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

from checks.registry import registered
from wardlake.session import build_session

HEADLINE = (
    "slv_vitals", "slv_patients", "snk_merge_cdc", "gold_patient_summary",
    "gold_encounter_metrics", "gold_daily_census", "gold_critical_alerts",
    "gold_quality_dashboard", "q1_population", "q2_age_groups", "q3_top_critical", "q4_wards",
    "q5_risk_dist", "q6_census_pivot", "q7_busiest_wards", "q8_alert_list",
    "q9_alerts_by_test", "q10_dq_kpis", "sem_domain_check", "nl_note_search",
    "rag_cosine_topk", "str_silver_upsert", "pipe_run",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    options = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
    }
    with contextlib.redirect_stdout(sys.stderr), tempfile.TemporaryDirectory(prefix="bench-") as shared:
        options["spark.checkpoint.dir"] = f"file://{shared}"
        spark = build_session("bench", f"local[{cpus}]", **options)
        spark.sparkContext.setLogLevel("ERROR")
        all_queries = registered()
        # Start the executors' code paths once, as a long-running job would have.
        all_queries["src_parquet"](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = {}
        for name in names:
            start = time.perf_counter()
            all_queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        version = spark.version
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": version,
            }
        )
    )


if __name__ == "__main__":
    main()
