"""Streaming queries that need no table protocol, and helpers around running queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.health import WINDOW_SECONDS, throughput_windows
from quotelake.operators.serving import with_dim
from quotelake.schema import SOURCE_COORDINATES
from quotelake.streaming.metrics import state_rows


def first_seen_within(quotes: DataFrame, delay: str) -> DataFrame:
    """First-seen symbols with state bounded by a watermark: a symbol may come again later."""
    return (
        quotes.select("symbol", "company_name", "sector", "event_time")
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["symbol"])
    )


def symbol_sessions(quotes: DataFrame, idle: str, delay: str) -> DataFrame:
    """When each symbol was quoted: from its first quote to ``idle`` after its last.

    State is an open session per symbol, and leaves when the watermark passes its end; a
    symbol that comes again later than that is first seen anew. Sessions of a batch are merged
    per task before the shuffle, so a hot symbol ships one row per task and session.
    """
    return (quotes.withWatermark("event_time", delay)
            .groupBy("symbol", F.session_window("event_time", idle).alias("session"))
            .agg(F.count("*").alias("quotes"))
            .select("symbol", F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), "quotes"))


def once_per_window(messages: DataFrame, delay: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Messages per closed window, each message once.

    A message read again within ``delay`` is not counted again. Messages at or before the
    watermark are late: they are dropped, one by one, by the first of the two stateful
    operators (``DEDUPE`` in the progress), so that its figure of dropped rows counts
    messages; that of the window counts groups of a task. State holds the coordinates of the
    messages of ``delay``, so keep it short where there are many.
    """
    once = messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(SOURCE_COORDINATES))
    return throughput_windows(once, "timestamp", seconds)


DEDUPE = "dedupeWithinWatermark"


def late_rows(query: StreamingQuery) -> int:
    """Messages that :func:`once_per_window` dropped as late, by the reported batches."""
    return sum(state_rows(query, DEDUPE, "numRowsDroppedByWatermark"))


def throughput_stream(messages: DataFrame, time_column: str = "timestamp",
                      delay: str | None = None, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Rows per window. With ``delay``: closed windows, append mode. Without: complete mode."""
    return throughput_windows(messages, time_column, seconds, delay)


def enrich_stream(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Live facts with company and sector from a static dimension."""
    return with_dim(facts, dim, ["company_name", "sector"])


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append a stream to a parquet folder with Spark's exactly-once file sink."""
    return (
        df.writeStream.format("parquet").outputMode("append").trigger(**trigger)
        .option("checkpointLocation", checkpoint).start(path)
    )


def run_available(query: StreamingQuery) -> None:
    """Wait until a query over the data at hand is through; raises what it raised."""
    query.awaitTermination()


def run_until_any_ends(spark: SparkSession) -> None:
    """Block until one query ends, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        stop_all(spark)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


PROGRESS_COLUMNS = (
    "batch_id bigint, started_at string, num_input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, batch_ms bigint"
)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The query's retained progress reports (Spark keeps the last 100) as rows."""
    rows = [
        (p["batchId"], p["timestamp"], p["numInputRows"], float(p.get("inputRowsPerSecond") or 0),
         float(p.get("processedRowsPerSecond") or 0), p["durationMs"].get("triggerExecution"))
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_COLUMNS)


def progress_throughput(progress: DataFrame) -> DataFrame:
    """Average and peak processed rows per second over the reports with input."""
    return progress.filter(F.col("num_input_rows") > 0).agg(
        F.avg("processed_rows_per_second").alias("avg_throughput"),
        F.max("processed_rows_per_second").alias("peak_throughput"),
    )
