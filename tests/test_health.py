from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from plan import executed, physical
from quotelake.operators import health
from quotelake.plans import frames

START = datetime(2024, 1, 1)


def times(spark, *seconds):
    return spark.createDataFrame([(START + timedelta(seconds=s),) for s in seconds], "timestamp timestamp")


def test_windows_latest_and_stats(spark):
    windows = health.throughput_windows(times(spark, 0, 9.9, 10, 25))
    counts = {r.window_start.second: r.records for r in windows.collect()}
    assert counts == {0: 2, 10: 1, 20: 1}
    latest = health.throughput_latest(windows).first()
    assert latest.window_end == START + timedelta(seconds=30) and latest.records_per_second == 0.1
    stats = health.throughput_stats(windows).first()
    assert stats.peak_throughput == 0.2 and stats.total_records == 4
    assert stats.avg_throughput == pytest.approx(4 / 3 / 10)
    assert stats.avg_mb_per_second == pytest.approx(4 / 30 * 1024 / 2**20)


def test_derived_columns(spark):
    row = health.derived_columns(spark.createDataFrame([(3,)], "value long")).first()
    assert (row.value_doubled, row.value_squared) == (6, 9.0)


def numpy_stats(values):
    return (np.mean(values), np.percentile(values, 95), np.percentile(values, 99),
            max(values), min(values))


@pytest.mark.parametrize("values", [
    [5], [1, 2], [7] * 40, list(range(1000)), [0, 10_000_000, -5, 1023, 1024, 1025],
    np.random.default_rng(1).integers(-10**9, 10**9, 2000).tolist(),
    np.random.default_rng(2).geometric(0.01, 3000).tolist() + [100] * 1500,
])
@pytest.mark.parametrize("width", [1, 64, 1024])
def test_latency_stats_equal_numpy(spark, values, width):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "latency_ms long")
    row = health.latency_stats(df, width=width).first()
    assert tuple(row) == pytest.approx(numpy_stats(values), rel=1e-12)


def test_latency_stats_per_group(spark):
    rng = np.random.default_rng(3)
    sizes = [("a", 300), ("b", 1), ("c", 77), (None, 20)]
    groups = {g: rng.integers(0, 5000, n).tolist() for g, n in sizes}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, latency_ms long")
    found = health.latency_stats(df, by=("g",), width=100).collect()
    assert len(found) == len(groups)
    for row in found:
        assert tuple(row)[1:] == pytest.approx(numpy_stats(groups[row.g]), rel=1e-12)


def test_latency_stats_of_nothing(spark):
    df = spark.createDataFrame([], "latency_ms long")
    assert tuple(health.latency_stats(df).first()) == (None,) * 5


def test_percentiles_count_values_before_they_shuffle(spark, events):
    df = frames.latencies(events).select(
        F.timestamp_diff("MILLISECOND", "event_time", "processing_time").alias("latency_ms"))
    text = physical(health.latency_stats(df))
    assert "percentile" not in text and "partial_count" in text


def test_percentiles_scan_the_rows_once(spark, events):
    df = frames.latencies(events).select(
        F.timestamp_diff("MILLISECOND", "event_time", "processing_time").alias("latency_ms"))
    final = executed(health.latency_stats(df)).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_group_and_two_level(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 10)], "worker string, latency_ms long")
    by_worker = {r.worker: tuple(r)[1:] for r in health.latency_by_group(df, "worker").collect()}
    assert by_worker == {"a": (2.0, 1, 3), "b": (10.0, 10, 10)}
    assert tuple(health.latency_two_level(df, "worker").first()) == (2, 6.0, 14)


def test_latest_by_time(spark):
    df = times(spark, 1, 3, 2).withColumn("id", F.monotonically_increasing_id())
    seconds = [r.timestamp.second for r in health.latest_by_time(df, "timestamp", "id", 2).collect()]
    assert seconds == [3, 2]
