"""Tables bucketed by symbol and sorted by time, the layout that serves reads by symbol.

Bucketed tables of one number of buckets meet in joins and aggregates by symbol without an
exchange, a symbol is looked up in its bucket alone, and within a file its rows lie together in
order of time. All facts of a symbol are one bucket, which one task reads: for a symbol that
holds a large share of all facts, read with ``spark.sql.sources.bucketing.enabled`` off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BUCKETS = 64


def save_bucketed(df: DataFrame, table: str, buckets: int = BUCKETS, key: str = "symbol",
                  *order: str) -> DataFrame:
    """Save a frame in the session's catalog, bucketed by ``key`` and sorted by it and ``order``.

    Each task writes its own file of a bucket, so no shuffle precedes the write and a hot
    bucket is written by many tasks; gather small inputs first.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)
    return df.sparkSession.table(table)


def latest_per_symbol(fact: DataFrame, *columns: str) -> DataFrame:
    """Each symbol's newest values by event time and id, by one aggregate without a sort."""
    at = F.struct("event_time", "id")
    return fact.groupBy("symbol").agg(F.max(at).alias("at"), *(F.max_by(c, at).alias(c) for c in columns)).select(
        "symbol", "at.event_time", *columns)


def with_bucketed_dim(fact: DataFrame, dim: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with columns of their symbol, by a merge of equal buckets: neither side moves."""
    return fact.join(dim.select("symbol", *columns).hint("merge"), "symbol")
