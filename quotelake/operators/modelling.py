"""Dimension and fact modelling, keys and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.operators.serving import packed_order
from quotelake.schema import FACT_COLUMNS, SOURCE_COORDINATES


def source_id() -> Column:
    """Compact id of a message from its source coordinates; the same on every replay."""
    return F.xxhash64(*SOURCE_COORDINATES)


def fact_rows(clean: DataFrame) -> DataFrame:
    """Fact projection in table order, with the id and source coordinates."""
    return clean.select(source_id().alias("id"), *FACT_COLUMNS, *SOURCE_COORDINATES)


def first_quotes(quotes: DataFrame, order: tuple[str, str] = ("event_time", "id"),
                 changed_at: str = "processing_time") -> DataFrame:
    """Each symbol's earliest quote: its names, its ``changed_at`` as updated_at, its order.

    Raw rows meet fixed-width aggregates only, per symbol and names; the choice among a
    symbol's few names follows. The result can be folded with that of other rows.
    """
    time, tie = order
    at = packed_order(F.col(time), F.col(tie))
    named = quotes.groupBy("symbol", "company_name", "sector").agg(
        F.min(at).alias("at"), F.min_by(changed_at, at).alias("updated_at"),
        F.min_by(time, at).alias(time), F.min_by(tie, at).alias(tie))
    first = F.min(F.struct("at", "company_name", "sector", "updated_at", time, tie))
    return named.groupBy("symbol").agg(first.alias("first")).select(
        "symbol", "first.company_name", "first.sector", "first.updated_at", f"first.{time}", f"first.{tie}")


def dim_first_seen(quotes: DataFrame, order: tuple[str, str] = ("event_time", "id"),
                   changed_at: str = "processing_time") -> DataFrame:
    """One row per symbol, taken from its earliest quote."""
    return first_quotes(quotes, order, changed_at).drop(*order)


def dim_rows(quotes: DataFrame, changed_at: str = "processing_time",
             arrival: str = "offset") -> DataFrame:
    """What each quote says about its symbol, in the dimension's columns.

    ``arrival`` orders quotes of the same event time; a keyed topic keeps a symbol in
    one partition, so its offsets do.
    """
    return quotes.select(
        "symbol", "company_name", "sector",
        F.col(changed_at).alias("created_at"),
        F.col(changed_at).alias("updated_at"),
        F.col("event_time").alias("last_event_time"),
        F.col(arrival).alias("last_offset"),
    )


def dim_changes(clean: DataFrame) -> DataFrame:
    """What one batch says about its symbols: one row each."""
    return merge_dim(dim_rows(clean))


def merge_dim(changes: DataFrame) -> DataFrame:
    """Fold change rows to one row per symbol.

    The row with the latest (event time, offset) wins and created_at stays the earliest,
    so the fold gives the same dimension for any order, grouping or repeat of batches.
    Rows are first reduced per symbol, names and change time, which is one for a whole
    batch, by fixed-width aggregates: no raw row is sorted.
    """
    at = packed_order(F.col("last_event_time"), F.col("last_offset"))
    reduced = changes.groupBy("symbol", "company_name", "sector", "updated_at").agg(
        F.max_by("last_event_time", at).alias("last_event_time"),
        F.max_by("last_offset", at).alias("last_offset"),
        F.min("created_at").alias("created_at"))
    latest = F.max(F.struct(
        "last_event_time", "last_offset", "updated_at", "company_name", "sector"))
    return (
        reduced.groupBy("symbol")
        .agg(latest.alias("latest"), F.min("created_at").alias("created_at"))
        .select(
            "symbol", "latest.company_name", "latest.sector", "created_at",
            "latest.updated_at", "latest.last_event_time", "latest.last_offset",
        )
    )


def dim_upsert(dim: DataFrame, rows: DataFrame) -> DataFrame:
    """Dimension after an upsert of dimension rows: update where known, insert where new.

    One aggregate over both sides matches and merges; there is no join.
    """
    return merge_dim(dim.unionByName(rows))


def fact_admitted(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts whose symbol the dimension knows."""
    return fact.join(dim.select("symbol"), "symbol", "left_semi")


def fact_orphans(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts whose symbol the dimension lacks."""
    return fact.join(dim.select("symbol"), "symbol", "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def delete_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """Rows left after a delete by symbol."""
    return df.filter(~F.col("symbol").eqNullSafe(symbol))
