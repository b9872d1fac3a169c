"""Stream health: throughput windows, latency columns and their statistics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelake.functions import megabytes_per_second, per_second

# Sampling window and message size of the throughput reports.
WINDOW_SECONDS = 10
MESSAGE_BYTES = 1024


def derived_columns(df: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``value_doubled`` and ``value_squared``."""
    value = F.col(column)
    return df.withColumn("value_doubled", value * 2).withColumn(
        "value_squared", F.pow(value, F.lit(2)))


def throughput_windows(df: DataFrame, time_column: str = "timestamp",
                       seconds: int = WINDOW_SECONDS, delay: str | None = None) -> DataFrame:
    """Rows per tumbling window. ``delay`` sets a watermark, for append-mode streams."""
    if delay:
        df = df.withWatermark(time_column, delay)
    return (
        df.groupBy(F.window(time_column, f"{seconds} seconds"))
        .agg(F.count("*").alias("records"))
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), "records")
    )


def partition_windows(df: DataFrame, time_column: str = "timestamp",
                      seconds: int = WINDOW_SECONDS, delay: str | None = None) -> DataFrame:
    """Rows per tumbling window and topic partition, with the first and last offset counted."""
    if delay:
        df = df.withWatermark(time_column, delay)
    return (
        df.groupBy(F.window(time_column, f"{seconds} seconds"), "topic", "partition")
        .agg(F.count("*").alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "topic", "partition", "records", "first_offset", "last_offset")
    )


def throughput_latest(windows: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """The newest window and its rate."""
    return windows.select(
        "window_end", "records", per_second(F.col("records"), seconds).alias("records_per_second")
    ).orderBy(F.col("window_end").desc_nulls_last()).limit(1)


def throughput_stats(windows: DataFrame, seconds: int = WINDOW_SECONDS,
                     message_bytes: int = MESSAGE_BYTES) -> DataFrame:
    """Average and peak rate over all windows, in records and megabytes."""
    totals = windows.agg(
        F.count("*").alias("samples"),
        F.sum("records").alias("total_records"),
        F.max("records").alias("peak_records"),
    )
    average = per_second(F.col("total_records") / F.col("samples"), seconds)
    peak = per_second(F.col("peak_records"), seconds)
    return totals.select(
        "samples", "total_records",
        average.alias("avg_throughput"), peak.alias("peak_throughput"),
        megabytes_per_second(average, message_bytes).alias("avg_mb_per_second"),
    )


def latest_by_time(df: DataFrame, time_column: str, tie: str, n: int = 100) -> DataFrame:
    """The n newest rows."""
    return df.orderBy(F.col(time_column).desc_nulls_last(), F.col(tie).desc_nulls_last()).limit(n)


def latest_stats(df: DataFrame, time_column: str, tie: str, column: str = "latency_ms",
                 n: int = 100) -> DataFrame:
    """Mean, maximum and minimum of a column over the n newest rows."""
    return latest_by_time(df, time_column, tie, n).agg(
        F.avg(column).alias("avg_latency_ms"), F.max(column).alias("max_latency_ms"),
        F.min(column).alias("min_latency_ms"))


def _before(counts: DataFrame, keys: list[str], level: str, name: str) -> DataFrame:
    """Rows of a level with the sum of ``_n`` over the earlier ones of the same keys."""
    earlier = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(*keys, level).agg(F.sum("_n").alias("_n"))
    return sums.withColumn(name, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], *added: str) -> DataFrame:
    same = reduce(and_, [left[c].eqNullSafe(right[c]) for c in keys])
    return left.join(right, same).select(left["*"], *(right[c] for c in added))


def _ranked_values(df: DataFrame, column: str, by: tuple[str, ...], width: int) -> DataFrame:
    """Distinct values with their count, first rank and the group's total.

    Rows are first counted per value, then the values per range of ``width`` and the
    ranges per block of ``width`` ranges. Ranks come from running counts over blocks, over
    the ranges of each block and over the values of each range, so no task holds more than
    ``width`` ranges or values, whatever the row count; the last window has a row per
    ``width`` squared of the spread.
    """
    # Nulls go by their count of 0 and the join is null-safe: a not-null filter on the
    # value would be pushed to the rows and compute the column a second time there.
    counts = df.groupBy(*by, F.col(column).alias("_v")).agg(F.count(column).alias("_n"))
    counts = counts.filter(F.col("_n") > 0).withColumn(
        "_range", F.floor(F.col("_v") / F.lit(width))).withColumn(
        "_block", F.floor(F.col("_range") / F.lit(width)))

    keys = list(by)
    blocks = _before(counts, keys, "_block", "_blocks_before").withColumn(
        "_total", F.sum("_n").over(Window.partitionBy(*keys)))
    ranges = _before(counts, [*keys, "_block"], "_range", "_ranges_before")
    ranges = _joined(ranges, blocks, [*keys, "_block"], "_blocks_before", "_total")
    earlier_values = Window.partitionBy(*keys, "_range").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, -1)
    start = (F.col("_blocks_before") + F.col("_ranges_before")
             + F.coalesce(F.sum("_n").over(earlier_values), F.lit(0)))
    joined = _joined(counts, ranges, [*keys, "_range"], "_blocks_before", "_ranges_before", "_total")
    return joined.withColumn("_start", start)


def _percentile(fraction: float) -> Column:
    """Aggregate over ranked values: linear interpolation between the two nearest ranks."""
    position = F.lit(float(fraction)) * (F.col("_total") - 1)

    def at(rank: Column) -> Column:
        hit = (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_n"))
        return F.max(F.when(hit, F.col("_v")))

    low, high = at(F.floor(position)), at(F.ceil(position))
    return low + (high - low) * F.max(position - F.floor(position))


def latency_stats(df: DataFrame, column: str = "latency_ms", by: tuple[str, ...] = (),
                  width: int = 1024) -> DataFrame:
    """Mean, exact p95 and p99, maximum and minimum of an integer column, per group."""
    ranked = _ranked_values(df, column, by, width)
    aggregates = [
        (F.sum(F.col("_v") * F.col("_n")).cast("double") / F.sum("_n")).alias("avg_latency_ms"),
        _percentile(0.95).alias("p95_latency_ms"),
        _percentile(0.99).alias("p99_latency_ms"),
        F.max("_v").alias("max_latency_ms"),
        F.min("_v").alias("min_latency_ms"),
    ]
    return ranked.groupBy(*by).agg(*aggregates)


def latency_by_group(df: DataFrame, group: str, column: str = "latency_ms") -> DataFrame:
    """Mean, minimum and maximum per group."""
    return df.groupBy(group).agg(
        F.avg(column).alias("avg_latency_ms"),
        F.min(column).alias("min_latency_ms"),
        F.max(column).alias("max_latency_ms"),
    )


def latency_two_level(df: DataFrame, worker: str, column: str = "latency_ms") -> DataFrame:
    """Mean of the workers' means and sum of their totals."""
    per_worker = df.groupBy(worker).agg(F.avg(column).alias("avg"), F.sum(column).alias("total"))
    return per_worker.agg(
        F.count("*").alias("num_workers"),
        F.round(F.avg("avg"), 6).alias("avg_response_time_ms"),
        F.sum("total").alias("total_execution_time_ms"),
    )
