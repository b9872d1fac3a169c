"""Tables of the streaming job, as folders that Spark's writer replaces whole.

A micro-batch writes its rows under its query and batch number, below their date in the fact
table and the daily parts. A repeated try of a batch replaces the same folders (in tables with
dates by dynamic partition overwrite), so a replay changes nothing. The daily summary is
stored final: a batch computes the dates it touches anew, from the daily parts of all batches,
and replaces just these. Readers leave files and partitions to Spark.

A job writes the dimension before the facts and the daily summary after its parts. A reader
may see a batch in one table and not yet in the next; it never sees a fact without its symbol.
One job at a time writes under a root. :func:`rewrite_tables` makes large files of many small.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from quotelake import schema
from quotelake.operators.modelling import first_quotes, merge_dim
from quotelake.operators.offsets import drop_repeated_reads
from quotelake.operators.serving import daily_partials, finish_daily, merge_daily

FACT_DAY, DAILY_DAY = "event_date", "trade_date"


@dataclass(frozen=True)
class Tables:
    root: str

    @property
    def fact(self) -> str:
        return f"{self.root}/fact"

    @property
    def dim(self) -> str:
        return f"{self.root}/dim"

    @property
    def daily_parts(self) -> str:
        return f"{self.root}/daily_parts"

    @property
    def daily(self) -> str:
        return f"{self.root}/daily"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def deletes(self) -> str:
        return f"{self.root}/deletes"


def write_batch(df: DataFrame, path: str, query_id: str, batch_id: int, day: str | None = None) -> None:
    """Write the folders of one micro-batch, below those of ``day`` if given, replacing an earlier try."""
    if day is None:
        df.write.mode("overwrite").parquet(f"{path}/query_id={query_id}/batch_id={batch_id}")
    else:
        _replace(df.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("long")}),
                 path, day, *(k.name for k in schema.BATCH_KEYS))


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace the partitions that the frame has rows of."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def _empty(spark: SparkSession, columns: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in columns])


def _read(spark: SparkSession, path: str, columns: T.StructType, within: str = "") -> DataFrame:
    """The table, or its folders that match ``within``; empty before the first batch."""
    try:
        return spark.read.schema(columns).option("basePath", path).parquet(f"{path}/{within}" if within else path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, columns)


def _scan(spark: SparkSession, path: str, columns: T.StructType, within: str = "") -> DataFrame:
    """The rows of all batches, with ``schema.BATCH_KEYS``."""
    return _read(spark, path, T.StructType([*columns.fields, *schema.BATCH_KEYS]), within)


def _days(column: str, days: list[date]) -> str:
    """Pattern of the folders of these dates."""
    return f"{column}={{{','.join(map(str, days))}}}"


def _between(column: str, first: date | None, last: date | None) -> str:
    if not first or not last:
        return ""
    return _days(column, [first + timedelta(n) for n in range(max(1, (last - first).days + 1))])


def _bounded(df: DataFrame, column: str, first: date | None, last: date | None) -> DataFrame:
    for bound, keep in ((first, F.col(column) >= F.lit(first)), (last, F.col(column) <= F.lit(last))):
        df = df.filter(keep) if bound else df
    return df


def written_dates(facts: DataFrame) -> list[date]:
    return [day for (day,) in facts.select(FACT_DAY).distinct().collect()]


def refresh_daily(spark: SparkSession, tables: Tables, dates: list[date]) -> None:
    """Compute the daily summary of these dates anew and replace them."""
    parts = _scan(spark, tables.daily_parts, schema.DAILY_PARTIAL, _days(DAILY_DAY, dates))
    merged = merge_daily(_without_deleted(parts, tables), F.max("load_time").alias("load_time"))
    _replace(finish_daily(merged, "load_time").repartition(DAILY_DAY), tables.daily, DAILY_DAY)


def _without_deleted(rows: DataFrame, tables: Tables) -> DataFrame:
    """Rows not covered by a later delete of their symbol."""
    deletes = _read(rows.sparkSession, tables.deletes, schema.DELETES)
    last = deletes.groupBy("symbol").agg(F.max("deleted_at").alias("deleted_at"))
    gone = (rows["symbol"] == last["symbol"]) & (rows["load_time"] <= last["deleted_at"])
    return rows.join(last, gone, "left_anti")


def read_fact(spark: SparkSession, tables: Tables, first: date | None = None, last: date | None = None) -> DataFrame:
    """The facts, or those of the dates from ``first`` to ``last``: other dates are not even listed."""
    return _facts(spark, tables, first, last).drop(*(k.name for k in schema.BATCH_KEYS))


def _facts(spark: SparkSession, tables: Tables, first: date | None = None, last: date | None = None) -> DataFrame:
    rows = _scan(spark, tables.fact, schema.FACT, _between(FACT_DAY, first, last))
    return _without_deleted(_bounded(rows, FACT_DAY, first, last), tables)


def read_dim(spark: SparkSession, tables: Tables, until: tuple[str, int] | None = None) -> DataFrame:
    """The dimension: one row per symbol. ``until``: as a query and batch number left it."""
    changes = _scan(spark, tables.dim, schema.DIM)
    if until:
        query_id, batch_id = until
        changes = changes.filter((F.col("query_id") != query_id) | (F.col("batch_id") <= batch_id))
    return merge_dim(changes.drop("query_id", "batch_id"))


def read_daily(spark: SparkSession, tables: Tables, first: date | None = None, last: date | None = None) -> DataFrame:
    """The stored daily summary; dates as in :func:`read_fact`."""
    rows = _read(spark, tables.daily, schema.DAILY, _between(DAILY_DAY, first, last))
    return _without_deleted(_bounded(rows, DAILY_DAY, first, last), tables).drop("load_time")


def read_first_seen(spark: SparkSession, path: str) -> DataFrame:
    """Each symbol's first quote, folded from what each batch saw first."""
    rows = _scan(spark, path, schema.FIRST_SEEN)
    return first_quotes(rows, ("event_time", "offset"), "updated_at").drop("event_time", "offset")


def read_quarantine(spark: SparkSession, tables: Tables) -> DataFrame:
    return _scan(spark, tables.quarantine, schema.QUARANTINE).drop(*(k.name for k in schema.BATCH_KEYS))


def read_throughput(spark: SparkSession, path: str) -> DataFrame:
    """Rows per window, over all queries that counted them.

    Of a query, the last counts of a window and topic partition stand. Those of several
    queries are added where their offsets lie apart, as when one goes on where another ended;
    where they overlap, as when a query whose checkpoint was lost reads the topic again, the
    highest counts.
    """
    of_window = ("window_start", "window_end", "topic", "partition")
    counted = _scan(spark, path, schema.THROUGHPUT).groupBy("query_id", *of_window).agg(
        F.max("records").alias("records"), F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    order = Window.partitionBy(*of_window).orderBy("first_offset", "last_offset", "query_id")
    reach = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.sum(F.when(F.col("first_offset") > F.col("reach"), 1).otherwise(0)).over(order)
    runs = counted.withColumn("reach", reach).withColumn("run", apart).groupBy(*of_window, "run").agg(
        F.max("records").alias("records"))
    return runs.groupBy("window_start", "window_end").agg(F.sum("records").alias("records"))


def delete_symbol_rows(spark: SparkSession, tables: Tables, symbol: str) -> None:
    """Delete a symbol's facts and daily rows loaded up to now.

    Adds one delete record that readers apply; nothing is rewritten, so a crash can
    lose nothing. :func:`rewrite_tables` drops the rows for good.
    """
    spark.range(1).select(
        F.lit(symbol).alias("symbol"), F.current_timestamp().alias("deleted_at")
    ).write.mode("append").parquet(tables.deletes)


def rewrite_tables(spark: SparkSession, source: Tables, target: Tables,
                   drop_repeated_offsets: bool = False, zero_as_null: bool = False) -> Tables:
    """Copy the tables into a new root, many small batch folders becoming one.

    Batches that a running stream writes meanwhile may be missing. The source stays as it was. Files are
    balanced by date with hot dates split and sorted by symbol and time, so that a scan
    for a symbol skips row groups; deletes are applied and batches folded.
    ``drop_repeated_offsets`` also removes messages a second query read again from the
    start of the topic; only batches whose offsets overlap are shuffled for it. Messages without
    an offset (partition ``schema.NO_PARTITION``, from text files) all stay: equal ones
    may be quotes of their own. ``zero_as_null`` must be what the job was started with.
    """
    facts = _facts(spark, source)
    if drop_repeated_offsets:
        facts = drop_repeated_reads(facts)
    facts = facts.drop(*(k.name for k in schema.BATCH_KEYS)).hint("rebalance", FACT_DAY).sortWithinPartitions(
        FACT_DAY, "symbol", "event_time")
    base = ("base", 0)
    write_batch(facts, target.fact, *base, FACT_DAY)
    write_batch(read_dim(spark, source), target.dim, *base)
    if drop_repeated_offsets:
        partials = daily_partials(_scan(spark, target.fact, schema.FACT), zero_as_null)
    else:
        partials = merge_daily(_without_deleted(_scan(spark, source.daily_parts, schema.DAILY_PARTIAL), source))
    write_batch(partials.withColumn("load_time", F.current_timestamp()), target.daily_parts, *base, DAILY_DAY)
    write_batch(read_quarantine(spark, source), target.quarantine, *base)
    days = written_dates(_scan(spark, target.fact, schema.FACT))
    if days:
        refresh_daily(spark, target, days)
    return target
