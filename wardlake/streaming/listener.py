"""Streaming progress as metric rows."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardlake.schemas import METRIC_ROW

DEFAULT_NAME = "bronze_streaming"


class MetricsListener(StreamingQueryListener):
    """Five rows per progress event, one when a query ends, and one per observed figure.

    Rows wait on the driver until ``flush``: a listener must not start Spark jobs.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._lock = threading.Lock()
        self._end_seen = threading.Condition()

    def _add(self, entity: str, figures: dict[str, float], tag: str) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        with self._lock:
            self._rows += [(now, entity, name, float(value), tag) for name, value in figures.items()]

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name or DEFAULT_NAME

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = {
            "active": 1,
            "input_rows_per_sec": progress.inputRowsPerSecond or 0,
            "processed_rows_per_sec": progress.processedRowsPerSecond or 0,
            "num_input_rows": progress.numInputRows or 0,
            "trigger_ms": (progress.durationMs or {}).get("triggerExecution", 0),
        }
        for row in (progress.observedMetrics or {}).values():
            figures |= {name: value or 0 for name, value in row.asDict().items()}
        self._add(progress.name or DEFAULT_NAME, figures, str(progress.batchId))

    def onQueryIdle(self, event) -> None:
        self._add(self._names.get(str(event.runId), DEFAULT_NAME), {"active": 1}, "idle")

    def onQueryTerminated(self, event) -> None:
        name = self._names.pop(str(event.runId), DEFAULT_NAME)
        self._add(name, {"active": 0}, "error" if event.exception else "0")
        with self._end_seen:
            self._ended.add(str(event.runId))
            self._end_seen.notify_all()

    def wait_for_end(self, queries: list[StreamingQuery], seconds: float = 30) -> bool:
        """Wait for the last event of ended queries: Spark delivers events afterwards."""
        runs = {str(query.runId) for query in queries}
        with self._end_seen:
            return self._end_seen.wait_for(lambda: runs <= self._ended, seconds)

    def rows(self) -> list[tuple]:
        with self._lock:
            return list(self._rows)

    def flush(self, spark: SparkSession, path: str, at_least: int = 1) -> int:
        """Append the waiting rows, if ``at_least`` so many, to the metrics table; they are
        kept if that fails."""
        waiting = self.rows()
        if len(waiting) < at_least:
            return 0
        if waiting:
            frame = spark.createDataFrame(waiting, METRIC_ROW).coalesce(1)
            frame.write.mode("append").parquet(path)
            with self._lock:
                del self._rows[: len(waiting)]
        return len(waiting)
