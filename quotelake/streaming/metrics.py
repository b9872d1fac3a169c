"""Observed figures of each micro-batch, delivered by a listener to a table."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quotelake import schema
from quotelake.streaming.tables import _scan, write_batch


class MetricsListener(StreamingQueryListener):
    """Writes each batch's progress as a row of the table at ``path``, when it is reported.

    Unlike ``recentProgress``, which keeps the last hundred reports, nothing is dropped, and the
    table outlives the driver. A batch that runs again after a crash replaces its row. Register
    with ``streams.addListener`` of the query's session before it starts; ``name`` is that of
    ``DataFrame.observe``, whose figures are kept by name.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "quotes") -> None:
        self.spark, self.path, self.name = spark, path, name
        self._ended: dict[str, threading.Event] = {}
        self.failures: list[Exception] = []

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        seen = progress.observedMetrics.get(self.name)
        figures = {k: int(v) for k, v in seen.asDict().items()} if seen else {}
        row = (datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")), progress.numInputRows,
               int(progress.durationMs.get("triggerExecution", 0)), figures)
        try:
            frame = self.spark.createDataFrame([row], schema.BATCH_METRICS).coalesce(1)
            write_batch(frame, self.path, str(progress.id), progress.batchId)
        except Exception as failure:  # an error here would be lost in the listener's thread
            self.failures.append(failure)

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all reports of an ended query are in the table."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the listener has not seen the end of the query")
        if self.failures:
            raise self.failures[0]


def read_metrics(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """query_id, batch_id, started_at, num_input_rows, batch_ms and the observed figures named."""
    rows = _scan(spark, path, schema.BATCH_METRICS)
    return rows.select("query_id", "batch_id", "started_at", "num_input_rows", "batch_ms",
                       *(F.col("figures").getItem(n).alias(n) for n in names))


def state_rows(query: StreamingQuery, operator: str, figure: str) -> list[int]:
    """A figure of a stateful operator, such as numRowsTotal, in each reported batch."""
    return [s[figure] for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"] == operator]
