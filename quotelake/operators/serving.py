"""Warehouse queries: daily summary, dashboards, recent rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

DAILY_KEYS = ("symbol", "trade_date")


def since(span: str, as_of: DataFrame | datetime | None) -> Column:
    """``span`` before ``as_of``: a time, now, or the only value of a one-row frame.

    The span is taken off inside the subquery: a bare subquery result is pushed to the
    scan as a bound, arithmetic on it is not.
    """
    interval = F.expr(f"INTERVAL {span}")
    if isinstance(as_of, DataFrame):
        return as_of.select(F.col(as_of.columns[0]) - interval).scalar()
    return (F.current_timestamp() if as_of is None else F.lit(as_of)) - interval


def volume_sum(name: str = "volume") -> Column:
    """Sum of volumes, as a decimal: honest volumes exceed 64 bits in the end."""
    return F.sum(F.col(name).cast("decimal(38,0)"))


def daily_partials(fact: DataFrame, zero_as_null: bool = False, *extra: Column) -> DataFrame:
    """Mergeable daily aggregates per symbol, with ``extra`` aggregates if any.

    ``zero_as_null`` ignores day highs and lows of 0, which mean "not known" in
    messages of producers without intraday ranges.
    """
    def bound(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(0)) if zero_as_null else F.col(name)

    return fact.groupBy("symbol", F.to_date("event_time").alias("trade_date")).agg(
        F.count("*").alias("num_transactions"),
        F.sum("price").alias("sum_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        volume_sum().alias("total_volume"),
        F.max(bound("day_high")).alias("highest_day_high"),
        F.min(bound("day_low")).alias("lowest_day_low"),
        *extra,
    )


def merge_daily(partials: DataFrame, *extra: Column) -> DataFrame:
    """Fold partials of several batches to one per symbol and date, with ``extra`` aggregates if any."""
    return partials.groupBy(*DAILY_KEYS).agg(
        F.sum("num_transactions").alias("num_transactions"),
        F.sum("sum_price").alias("sum_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
        F.max("highest_day_high").alias("highest_day_high"),
        F.min("lowest_day_low").alias("lowest_day_low"),
        *extra,
    )


def finish_daily(partials: DataFrame, *extra: str) -> DataFrame:
    """Merged partials -> the summary's columns, and ``extra`` ones."""
    return partials.select(
        "symbol", "trade_date", "num_transactions",
        (F.col("sum_price").cast("double") / F.col("num_transactions")).alias("avg_price"),
        "max_price", "min_price", "total_volume", "highest_day_high", "lowest_day_low", *extra,
    )


def daily_summary(fact: DataFrame, zero_as_null: bool = False) -> DataFrame:
    """Count, prices, volume and range per symbol and day."""
    return finish_daily(daily_partials(fact, zero_as_null))


def daily_on_date(daily: DataFrame, day: date | Column | None = None) -> DataFrame:
    """Summary rows of one date; today by default."""
    day = F.current_date() if day is None else (day if isinstance(day, Column) else F.lit(day))
    return daily.filter(F.col("trade_date") == day)


def symbol_totals(fact: DataFrame) -> DataFrame:
    """Average price and total volume per symbol."""
    return fact.groupBy("symbol").agg(
        (F.sum("price").cast("double") / F.count("price")).alias("avg_price"),
        volume_sum().alias("total_volume"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def recent(fact: DataFrame, span: str = "1 HOUR",
           as_of: DataFrame | datetime | None = None) -> DataFrame:
    """Facts of the last ``span`` before ``as_of`` (now by default).

    event_time stays bare on its side of the comparison, so the bound reaches the scan:
    with times stored as micros (a setting of ``quotelake.session``) it skips row groups. A
    table partitioned by event_date is also pruned to the dates in question. Columns of
    type timestamp_ntz get no such bound from Spark.
    """
    start = since(span, as_of)
    found = fact.filter(F.col("event_time") >= start)
    if "event_date" in fact.columns:
        found = found.filter(F.col("event_date") >= F.to_date(start))
    return found


def with_dim(fact: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with columns of their symbol's dimension row (inner join).

    No hint: Spark broadcasts the dimension only while its size is under
    autoBroadcastJoinThreshold. Beyond that both sides shuffle on the symbol and
    adaptive execution splits the partition of a hot symbol.
    """
    return fact.join(dim.select("symbol", *columns), "symbol")


def dashboard(fact: DataFrame, dim: DataFrame, span: str = "1 HOUR",
              as_of: DataFrame | datetime | None = None) -> DataFrame:
    """Recent facts with company and sector, newest first."""
    joined = with_dim(recent(fact, span, as_of), dim, ["company_name", "sector"])
    return joined.select(*fact.columns, "company_name", "sector").orderBy(
        F.col("event_time").desc_nulls_last())


def recent_with_company(fact: DataFrame, dim: DataFrame, span: str = "1 DAY",
                        as_of: DataFrame | datetime | None = None) -> DataFrame:
    """Recent facts with their company name."""
    joined = with_dim(recent(fact, span, as_of), dim, ["company_name"])
    return joined.select(*fact.columns, "company_name")


def time_order(fact: DataFrame) -> list[str]:
    """Columns that put facts in order: event time, then arrival.

    Where facts carry the source offset, it tells which of two quotes of the same time
    came later; the id makes the order total.
    """
    return ["event_time", *(c for c in ("offset", "id") if c in fact.columns)]


def packed_order(time: Column, tie: Column) -> Column:
    """A time and a 64-bit number as one decimal of the same order, which aggregates on
    fixed-width buffers can compare."""
    micros = F.unix_micros(time.cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit(str(2 ** 64)).cast("decimal(20,0)")).cast("decimal(38,0)") + tie.cast("decimal(19,0)")


def arrival_order(fact: DataFrame) -> Column:
    """``time_order`` as one number. Facts of one symbol, time and offset are one message."""
    _, tie, *_ = time_order(fact)
    return packed_order(F.col("event_time"), F.col(tie))


def newest(fact: DataFrame, n: int = 1000) -> DataFrame:
    """The n newest facts."""
    return fact.orderBy(*[F.col(c).desc_nulls_last() for c in time_order(fact)]).limit(n)


def register_views(spark, fact: DataFrame, dim: DataFrame, daily: DataFrame) -> None:
    """Temp views under the warehouse's table and view names, for SQL users.

    ``daily`` is the stored summary (``tables.read_daily``), which the stream keeps up to
    date, so that a day's figures cost no scan of facts.
    """
    # Names that existing SQL uses.
    fact.createOrReplaceTempView("fact_stock_prices")
    dim.createOrReplaceTempView("dim_stock")
    daily.createOrReplaceTempView("mv_daily_stock_summary")
    dashboard(fact, dim).createOrReplaceTempView("vw_realtime_stock_dashboard")
