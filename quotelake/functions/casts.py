"""Lenient casts: a bad value becomes null instead of failing the job (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quotelake.schema import MONEY, PERCENT

# A date-time with one or two digits per field; anything after the seconds is ignored.
_TIME_PREFIX = r"^(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})"


def as_money(value: Column) -> Column:
    """decimal(10,2), half-up; null on overflow."""
    return value.try_cast(MONEY)


def as_percent(value: Column) -> Column:
    """decimal(5,2), half-up; null on overflow."""
    return value.try_cast(PERCENT)


def as_share_count(value: Column) -> Column:
    """bigint from an integer, decimal or text; 0 where there is no number."""
    return F.coalesce(value.try_cast("decimal(20,0)").try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_event_time(text: Column, keep_fraction: bool = False) -> Column:
    """Timestamp of an ISO-8601 text; null when it is not one.

    By default the wall-clock fields up to the second count and the rest (fraction,
    zone) is dropped. ``keep_fraction`` honours both.
    """
    if keep_fraction:
        return text.try_cast("timestamp")
    exact = F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    short_fields = F.regexp_extract(text, _TIME_PREFIX, 1).try_cast("timestamp")
    return F.coalesce(exact, short_fields)


def strip_percent(text: Column) -> Column:
    """'-1.25%' -> '-1.25'."""
    return F.replace(text, F.lit("%"), F.lit(""))
