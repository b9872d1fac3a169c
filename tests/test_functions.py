from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.functions import (
    as_money, as_percent, as_share_count, latency_ms, megabytes_per_second, parse_event_time,
    per_second, strip_percent, whole_second_latency_ms,
)


def value_of(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("raw, expected", [
    (10.005, "10.01"), (2.675, "2.68"), (-0.004, "0.00"), (99999999.99, "99999999.99"),
])
def test_money_rounds_half_up(spark, raw, expected):
    assert value_of(spark, as_money(F.lit(raw))) == Decimal(expected)


@pytest.mark.parametrize("raw", [1e8, 123456789.0, -1e9, float("nan"), float("inf")])
def test_money_overflow_is_null(spark, raw):
    assert value_of(spark, as_money(F.lit(raw))) is None


def test_percent_overflow_is_null(spark):
    assert value_of(spark, as_percent(F.lit(1234.5))) is None
    assert value_of(spark, as_percent(F.lit(-1.25))) == Decimal("-1.25")


@pytest.mark.parametrize("raw, expected", [
    ("5", 5), ("3000000000", 3_000_000_000), ("1000.0", 1000), ("12.6", 13), ("abc", 0),
    ("1e30", 0), (None, 0), ("", 0), ("-4", -4),
])
def test_share_count(spark, raw, expected):
    assert value_of(spark, as_share_count(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("2024-01-02T03:04:05.123456", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05+09:00", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-1-2T3:4:5", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-1-2T3:4:5.999", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02", None), ("2024-13-02T03:04:05", None), ("bogus", None), ("", None), (None, None),
])
def test_event_time_keeps_wall_clock_seconds(spark, raw, expected):
    text = parse_event_time(F.lit(raw).cast("string")).cast("timestamp_ntz")
    assert value_of(spark, text) == expected


def test_event_time_with_fraction_and_zone(spark):
    parsed = parse_event_time(F.lit("2024-01-02T03:04:05.25+01:00"), keep_fraction=True)
    assert value_of(spark, parsed.cast("timestamp_ntz")) == datetime(2024, 1, 2, 2, 4, 5, 250000)


def test_strip_percent(spark):
    assert value_of(spark, strip_percent(F.lit("-1.25%"))) == "-1.25"


def test_latency_resolutions(spark):
    start, end = F.expr("timestamp'2024-01-01 00:00:00.1'"), F.expr("timestamp'2024-01-01 00:00:00.9'")
    assert value_of(spark, whole_second_latency_ms(start, end)) == 0
    assert value_of(spark, latency_ms(start, end)) == 800


def test_rates(spark):
    assert value_of(spark, per_second(F.lit(50), 10)) == 5.0
    assert value_of(spark, megabytes_per_second(F.lit(2048.0), 1024)) == 2.0
