"""The star-schema job: one stream, one micro-batch function, dimension before facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.cleaning import accepted, flag_quotes, rejected
from quotelake.operators.health import WINDOW_SECONDS, partition_windows
from quotelake.operators.ingest import parse_quotes
from quotelake.operators.modelling import dim_changes, fact_rows, first_quotes
from quotelake.operators.serving import daily_partials, with_dim
from quotelake.operators.sketches import quantile_partials
from quotelake.streaming.tables import DAILY_DAY, FACT_DAY, Tables, read_dim, refresh_daily, write_batch, written_dates

# Fixed value: trigger interval of the fact writer.
FACT_TRIGGER = "5 seconds"

BatchHook = Callable[[DataFrame, DataFrame], None]


def stream_query_id(spark: SparkSession) -> str:
    """Id of the streaming query whose batch function is running; it survives restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def flag_messages(messages: DataFrame, volume=None, **options) -> DataFrame:
    """Messages -> typed rows with a reject reason; options as in ``flag_quotes``."""
    return flag_quotes(parse_quotes(messages, volume, keep_raw=True), **options)


def write_star(flagged: DataFrame, tables: Tables, query_id: str, batch_id: int,
               after_write: BatchHook | None = None, backfill: bool = False,
               zero_as_null: bool = False) -> None:
    """Write one batch of flagged rows: dimension, facts, quarantine, daily parts, daily summary.

    The dimension comes from the same rows and is first, so no fact lacks its symbol. A
    repeated try replaces what an earlier one wrote. The batch is parsed once and kept while
    the tables are written; lost blocks are computed again from the source.
    """
    flagged = flagged.persist(StorageLevel.MEMORY_AND_DISK)
    batch = (query_id, batch_id)
    try:
        if flagged.isEmpty():
            return
        clean = accepted(flagged)
        changes = dim_changes(clean)
        facts = fact_rows(clean).withColumn(FACT_DAY, F.to_date("event_time"))
        write_batch(changes, tables.dim, *batch)
        write_batch(facts.hint("rebalance", FACT_DAY) if backfill else facts, tables.fact, *batch, FACT_DAY)
        bad = rejected(flagged).select(
            "reject_reason", "raw_value", "symbol", "processing_time",
            "topic", "partition", "offset")
        write_batch(bad, tables.quarantine, *batch)
        parts = daily_partials(facts, zero_as_null, F.max("load_time").alias("load_time"))
        write_batch(parts.hint("rebalance", DAILY_DAY) if backfill else parts, tables.daily_parts, *batch, DAILY_DAY)
        if days := written_dates(facts):
            refresh_daily(flagged.sparkSession, tables, days)
        if after_write:
            after_write(changes, facts)
    finally:
        flagged.unpersist()


def start_star_job(messages: DataFrame, tables: Tables, checkpoint: str,
                   trigger: dict | None = None, name: str | None = None,
                   after_write: BatchHook | None = None, backfill: bool = False,
                   zero_as_null: bool = False, **options) -> StreamingQuery:
    """Start the job on a stream in topic layout.

    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``. ``after_write`` gets
    the dimension changes and facts of each batch, for a further sink such as a database;
    what it writes is repeated when a batch is. ``backfill`` is for batches of many days:
    facts and daily parts are first gathered by date, with hot dates split, so that a batch of
    n tasks and d days writes about d files each and not n times d. A live batch has one or two days
    and needs no such shuffle. ``zero_as_null`` is that of ``daily_partials``; other
    options are those of ``flag_messages``.
    """
    flagged = flag_messages(messages, **options).observe(
        "quotes", F.count("*").alias("read"), F.count("reject_reason").alias("rejected"))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        write_star(batch, tables, stream_query_id(batch.sparkSession), batch_id,
                   after_write, backfill, zero_as_null)

    writer = (
        flagged.writeStream.foreachBatch(run_batch)
        .trigger(**(trigger or {"processingTime": FACT_TRIGGER}))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.queryName(name) if name else writer).start()


def start_enriched_job(messages: DataFrame, tables: Tables, path: str, checkpoint: str,
                       trigger: dict, **options) -> StreamingQuery:
    """Facts with company and sector from the dimension as each batch leaves it.

    A batch adds its changes to the dimension and then joins its facts with it, so a symbol
    renamed by a batch has its new name from that batch on, and a replayed batch sees the
    dimension as at its first try. Options are those of ``flag_messages``.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark, query_id = batch.sparkSession, stream_query_id(batch.sparkSession)
        clean = accepted(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if clean.isEmpty():
                return
            write_batch(dim_changes(clean), tables.dim, query_id, batch_id)
            dim = read_dim(spark, tables, (query_id, batch_id))
            write_batch(with_dim(fact_rows(clean), dim, ["company_name", "sector"]), path, query_id, batch_id)
        finally:
            clean.unpersist()

    return (flag_messages(messages, **options).writeStream.foreachBatch(run_batch).trigger(**trigger)
            .option("checkpointLocation", checkpoint).start())


def start_first_seen_job(clean: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Keep each symbol's first quote in a table of batch directories.

    A batch is reduced to a row per symbol before its shuffle and readers fold the batches,
    so no row of a hot symbol is shuffled and there is no state to grow.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        first = first_quotes(batch, ("event_time", "offset"))
        write_batch(first, path, stream_query_id(batch.sparkSession), batch_id)

    return (clean.writeStream.foreachBatch(run_batch).trigger(**trigger)
            .option("checkpointLocation", checkpoint).start())


def start_sketch_job(rows: DataFrame, column: str, by: tuple[str, ...], path: str, checkpoint: str,
                     trigger: dict) -> StreamingQuery:
    """Keep one quantile sketch per batch and group; ``sketches.merged_quantiles`` reads them."""
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(quantile_partials(batch, column, by), path, stream_query_id(batch.sparkSession), batch_id)

    return (rows.writeStream.foreachBatch(run_batch).trigger(**trigger)
            .option("checkpointLocation", checkpoint).start())


def start_throughput_job(messages: DataFrame, path: str, checkpoint: str, trigger: dict,
                         time_column: str = "timestamp", delay: str | None = None,
                         seconds: int = WINDOW_SECONDS) -> StreamingQuery:
    """Keep the row count of every window and topic partition, open windows too, in a table of
    batch folders that ``tables.read_throughput`` adds up.

    Update mode: a batch writes only the windows it changed, where complete mode would
    write all of them again. Without ``delay`` no row is too late and state keeps one
    count per window; with it, older windows leave the state.
    """
    def run_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, stream_query_id(batch.sparkSession), batch_id)

    return (
        partition_windows(messages, time_column, seconds, delay)
        .writeStream.outputMode("update").foreachBatch(run_batch)
        .trigger(**trigger).option("checkpointLocation", checkpoint).start()
    )
