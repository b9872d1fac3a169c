"""Latency and rate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: bytes per megabyte in throughput reports.
BYTES_PER_MB = 1024 * 1024


def whole_second_latency_ms(start: Column, end: Column) -> Column:
    """Difference of the two times in whole seconds, as milliseconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) * 1000


def latency_ms(start: Column, end: Column) -> Column:
    """Exact difference in milliseconds, fraction dropped."""
    return F.timestamp_diff("MILLISECOND", start, end)


def per_second(count: Column, seconds: float) -> Column:
    return count / F.lit(float(seconds))


def megabytes_per_second(records_per_second: Column, message_bytes: int) -> Column:
    return records_per_second * F.lit(message_bytes) / F.lit(BYTES_PER_MB)
