"""Typing, defaults and reject reasons for parsed quotes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.functions import as_money, as_percent, as_share_count, parse_event_time
from quotelake.schema import (
    COMPANY_LENGTH, SECTOR_LENGTH, SOURCE_COORDINATES, SYMBOL_LENGTH, UNKNOWN_SECTOR,
)


def _too_long(column: str, limit: int) -> Column:
    return F.char_length(column) > limit


# Reason -> condition on the typed row, in order; the first that holds is reported.
RULES: dict[str, Callable[[], Column]] = {
    "symbol_null": lambda: F.col("symbol").isNull(),
    "symbol_empty": lambda: F.col("symbol") == "",
    "symbol_long": lambda: _too_long("symbol", SYMBOL_LENGTH),
    "price_null": lambda: F.col("price").isNull(),
    "event_time_bad": lambda: F.col("event_time").isNull(),
    "company_long": lambda: _too_long("company_name", COMPANY_LENGTH),
    "sector_long": lambda: _too_long("sector", SECTOR_LENGTH),
}
ALL_RULES = tuple(RULES)
# The two filters without which a row has no meaning; the rest guard the tables.
MINIMAL_RULES = ("symbol_null", "price_null")


def type_quotes(parsed: DataFrame, default_event_time: Column | None = None,
                keep_fraction: bool = False) -> DataFrame:
    """Parsed fields -> warehouse types, with defaults; bad values become null.

    A null event_time takes ``default_event_time``, else the broker's time of the
    message, else the batch time. An event_time that does not parse stays null.
    """
    now = F.current_timestamp()
    if default_event_time is None:
        default_event_time = (
            F.coalesce("broker_time", now) if "broker_time" in parsed.columns else now
        )
    if not keep_fraction:
        default_event_time = F.date_trunc("second", default_event_time)
    event_time = F.when(F.col("event_time").isNull(), default_event_time).otherwise(
        parse_event_time(F.col("event_time"), keep_fraction)
    )
    carried = [c for c in (*SOURCE_COORDINATES, "raw_value") if c in parsed.columns]
    return parsed.select(
        "symbol",
        as_money(F.col("price")).alias("price"),
        as_share_count(F.col("volume")).alias("volume"),
        as_money(F.col("day_high")).alias("day_high"),
        as_money(F.col("day_low")).alias("day_low"),
        as_money(F.col("change")).alias("change"),
        as_percent(F.col("change_percent")).alias("change_percent"),
        event_time.alias("event_time"),
        now.alias("processing_time"),
        now.alias("load_time"),
        F.coalesce("company_name", "symbol").alias("company_name"),
        F.coalesce("sector", F.lit(UNKNOWN_SECTOR)).alias("sector"),
        *carried,
    )


def reject_reason(rules: tuple[str, ...] = ALL_RULES) -> Column:
    """First broken rule of a typed row, null when it is good."""
    reason = F.lit(None).cast("string")
    for name in reversed(rules):
        reason = F.when(RULES[name](), F.lit(name)).otherwise(reason)
    return reason


def flag_quotes(parsed: DataFrame, default_event_time: Column | None = None,
                keep_fraction: bool = False,
                rules: tuple[str, ...] = ALL_RULES) -> DataFrame:
    """Typed quotes with ``reject_reason``; splits into clean and quarantined rows.

    Only a rejected row keeps its ``raw_value``.
    """
    flagged = type_quotes(parsed, default_event_time, keep_fraction).withColumn(
        "reject_reason", reject_reason(rules))
    if "raw_value" in flagged.columns:
        raw = F.when(F.col("reject_reason").isNotNull(), F.col("raw_value"))
        flagged = flagged.withColumn("raw_value", raw)
    return flagged


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_value")


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("reject_reason").isNotNull())


def clean_quotes(parsed: DataFrame, **options) -> DataFrame:
    """The rows that break no rule. Options as in :func:`flag_quotes`."""
    return accepted(flag_quotes(parsed, **options))


def quarantine_quotes(parsed: DataFrame, **options) -> DataFrame:
    """The complement of :func:`clean_quotes`, each row with its reason."""
    return rejected(flag_quotes(parsed, **options))
