"""Price, volume, sector and risk datasets behind the dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotelake.operators.serving import arrival_order, daily_partials, volume_sum


def latest_quote(fact: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` (of fixed width) of each symbol's newest fact.

    An aggregate rather than a window: it keeps one row per symbol on the map side,
    so a hot symbol costs no more to shuffle than any other. The order is one number, so
    the aggregate hashes; a struct would make Spark sort every fact.
    """
    order = arrival_order(fact)
    return fact.groupBy("symbol").agg(*[F.max_by(c, order).alias(c) for c in columns])


def latest_price(fact: DataFrame) -> DataFrame:
    """Latest price and change percent per symbol."""
    return latest_quote(fact, ("price", "change_percent", "event_time", "id"))


def price_trend(fact: DataFrame, bucket: str = "hour") -> DataFrame:
    """Average, low, high, first and last price per symbol and time bucket."""
    order = arrival_order(fact)
    at = F.date_trunc(bucket, "event_time").cast(fact.schema["event_time"].dataType)
    return fact.groupBy("symbol", at.alias("bucket")).agg(
        (F.sum("price").cast("double") / F.count("price")).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min_by("price", order).alias("first_price"),
        F.max_by("price", order).alias("last_price"),
    )


def volume_by_symbol(fact: DataFrame) -> DataFrame:
    return fact.groupBy("symbol").agg(volume_sum().alias("total_volume"))


def volume_over_time(fact: DataFrame) -> DataFrame:
    """Volume per symbol and day with the running total of the symbol."""
    per_day = fact.groupBy("symbol", F.to_date("event_time").alias("trade_date")).agg(
        volume_sum().alias("total_volume"))
    so_far = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("running_volume", F.sum("total_volume").over(so_far))


def share_of_total(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Adds each row's share of the column total, read as a one-row scalar subquery."""
    total = df.agg(F.sum(measure).cast("double").alias("total")).scalar()
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double"), total))


def market_share(fact: DataFrame) -> DataFrame:
    """Volume per symbol and its share of all volume."""
    return share_of_total(volume_by_symbol(fact), "total_volume", "share")


def sector_distribution(dim: DataFrame) -> DataFrame:
    """Symbols per sector and the sector's share of all symbols."""
    counts = dim.groupBy("sector").agg(F.count("symbol").alias("num_symbols"))
    return share_of_total(counts, "num_symbols", "share")


def _per_symbol(fact: DataFrame) -> DataFrame:
    return fact.groupBy("symbol").agg(
        F.sum("change_percent").alias("sum_change_percent"),
        F.count("change_percent").alias("num_change_percent"),
        volume_sum().alias("total_volume"),
        F.count("*").alias("num_transactions"),
    )


def sector_performance(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Average change percent, volume and rows per sector.

    Facts are reduced to a row per symbol before they meet the dimension, so the join
    sees no raw facts and no hot symbol.
    """
    joined = _per_symbol(fact).join(dim.select("symbol", "sector"), "symbol")
    return joined.groupBy("sector").agg(
        (F.sum("sum_change_percent").cast("double") / F.sum("num_change_percent"))
        .alias("avg_change_percent"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("num_transactions").alias("num_transactions"),
    )


def sector_matrix(fact: DataFrame, dim: DataFrame, sectors: list[str]) -> DataFrame:
    """One row per symbol, one column per sector: the average change percent. Sectors
    outside the list, and none, are in the column ``other``."""
    joined = _per_symbol(fact).join(dim.select("symbol", "sector"), "symbol")
    average = F.col("sum_change_percent").cast("double") / F.col("num_change_percent")
    named = joined.withColumn("sector", F.when(F.col("sector").isin(sectors), F.col("sector")).otherwise("other"))
    return named.groupBy("symbol").pivot("sector", [*sectors, "other"]).agg(F.max(average))


def risk_return(fact: DataFrame, digits: int = 6) -> DataFrame:
    """Standard deviation against mean of the change percent, per symbol."""
    change = F.col("change_percent").cast("double")
    return fact.groupBy("symbol").agg(
        F.round(F.stddev_samp(change), digits).alias("risk"),
        F.round(F.avg(change), digits).alias("mean_return"),
    )


def moving_average(fact: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """Average price over each symbol's last ``days`` trade dates, weighted by rows.

    ``calendar`` counts calendar days instead of dates with trades. The window runs
    over one row per symbol and day, never over raw facts.
    """
    daily = daily_partials(fact).select("symbol", "trade_date", "num_transactions", "sum_price")
    per_symbol = Window.partitionBy("symbol")
    if calendar:
        frame = per_symbol.orderBy(F.unix_date("trade_date")).rangeBetween(1 - days, 0)
    else:
        frame = per_symbol.orderBy("trade_date").rowsBetween(1 - days, 0)
    moving = F.sum("sum_price").over(frame).cast("double") / F.sum("num_transactions").over(frame)
    return daily.select("symbol", "trade_date", moving.alias("moving_avg_price"))


def movers(fact: DataFrame, k: int, best: bool) -> DataFrame:
    """The k symbols with the highest (or lowest) latest change percent."""
    order: Column = F.col("change_percent")
    order = order.desc_nulls_last() if best else order.asc_nulls_last()
    return latest_price(fact).select("symbol", "change_percent", "price").orderBy(
        order, "symbol").limit(k)


def gainers(fact: DataFrame, k: int = 10) -> DataFrame:
    return movers(fact, k, best=True)


def losers(fact: DataFrame, k: int = 10) -> DataFrame:
    return movers(fact, k, best=False)
