"""File twins of a topic, for runs without a broker, and the synthetic rate source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotelake.schema import NO_PARTITION, TOPIC


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


def _admission(files_per_trigger: int | None, bytes_per_trigger: int | None) -> dict[str, str]:
    """Limit of a micro-batch, by number or size of files; Spark takes one of the two."""
    if files_per_trigger:
        return {"maxFilesPerTrigger": str(files_per_trigger)}
    return {"maxBytesPerTrigger": str(bytes_per_trigger)} if bytes_per_trigger else {}


def stream_topic_files(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                       bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream of a directory of parquet files in topic layout."""
    limits = _admission(files_per_trigger, bytes_per_trigger)
    return spark.readStream.schema(TOPIC).options(**limits).parquet(path)


def stream_text_files(spark: SparkSession, path: str, files_per_trigger: int | None = None,
                      bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON-lines files in topic layout.

    Text has no row number, so the coordinates of a message are its file and the hash
    of its text; equal lines of one file share them, which the partition tells.
    """
    limits = _admission(files_per_trigger, bytes_per_trigger)
    return spark.readStream.options(**limits).text(path).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("topic"),
        F.lit(NO_PARTITION).alias("partition"),
        F.xxhash64("value").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def write_topic_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    messages.write.mode(mode).parquet(path)


def rate_stream(spark: SparkSession, rows_per_second: int = 1000) -> DataFrame:
    """Synthetic (timestamp, value) rows."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def rate_batches(spark: SparkSession, rows_per_batch: int, start_ms: int = 0,
                 advance_ms: int = 1000) -> DataFrame:
    """Synthetic rows that are the same on every run."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", advance_ms)
        .load()
    )
