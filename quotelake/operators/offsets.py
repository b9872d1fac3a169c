"""Message offsets: gaps that lost messages leave, and messages read more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quotelake.schema import NO_PARTITION, SOURCE_COORDINATES
from quotelake.sources.staging import small_side, stage_table

TOPIC_PARTITION = ("topic", "partition")
BATCH = ("query_id", "batch_id")

# Offsets that one task puts in order.
RANGE = 1 << 16


def numbered(messages: DataFrame) -> DataFrame:
    """Messages whose source numbers them."""
    return messages.filter(F.col("partition") != NO_PARTITION)


def offset_gaps(messages: DataFrame, expected: DataFrame | None = None, width: int = RANGE) -> DataFrame:
    """Runs of missing offsets per topic partition: from_offset, to_offset, missing.

    Offsets are put in order within ranges of ``width``, and the last offset of a range is
    compared with the first of the next, so a topic with one hot partition is sorted by as
    many tasks as it has ranges. ``expected`` (topic, partition, first_offset, last_offset)
    adds what is missing at either end, such as messages that expired before they were read.
    An offset that was read several times counts once, before the shuffle.
    """
    seen = numbered(messages).select(*SOURCE_COORDINATES)
    if expected is not None:
        seen = seen.unionByName(expected.select(*TOPIC_PARTITION, F.explode(
            F.array(F.col("first_offset") - 1, F.col("last_offset") + 1)).alias("offset")))
    ranged = seen.withColumn("range", F.floor(F.col("offset") / width)).distinct()

    in_range = Window.partitionBy(*TOPIC_PARTITION, "range").orderBy("offset")
    inner = ranged.select(*TOPIC_PARTITION, F.lag("offset").over(in_range).alias("before"), F.col("offset").alias("after"))
    edges = ranged.groupBy(*TOPIC_PARTITION, "range").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    ranges = Window.partitionBy(*TOPIC_PARTITION).orderBy("range")
    outer = edges.select(*TOPIC_PARTITION, F.lag("last").over(ranges).alias("before"), F.col("first").alias("after"))
    return inner.unionByName(outer).filter(F.col("after") - F.col("before") > 1).select(
        *TOPIC_PARTITION, (F.col("before") + 1).alias("from_offset"), (F.col("after") - 1).alias("to_offset"),
        (F.col("after") - F.col("before") - 1).alias("missing"))


def read_intervals(facts: DataFrame) -> DataFrame:
    """First and last offset of each topic partition in each batch."""
    return numbered(facts).groupBy(*BATCH, *TOPIC_PARTITION).agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def overlapping(intervals: DataFrame) -> DataFrame:
    """The intervals that share an offset with another of their topic partition.

    In the order of their first offsets, an interval meets an earlier one if it starts before
    the furthest end so far, and a later one if the next starts before its own end.
    """
    order = Window.partitionBy(*TOPIC_PARTITION).orderBy("first_offset", "last_offset", *BATCH)
    reach = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead("first_offset").over(order)
    return (intervals.withColumn("reach", reach).withColumn("following", following)
            .filter((F.col("first_offset") <= F.col("reach")) | (F.col("following") <= F.col("last_offset")))
            .drop("reach", "following"))


def drop_repeated_reads(facts: DataFrame) -> DataFrame:
    """Facts without those of messages that were read before; needs the columns ``BATCH``.

    A query that starts again after its checkpoint is lost reads old messages again. Only
    batches whose offset intervals overlap can hold such messages: their facts are shuffled
    by offset and the first loaded stays. All other facts, and those of sources that do not
    number messages, pass without a shuffle.
    """
    shared = small_side(stage_table(overlapping(read_intervals(facts)).select(*BATCH, *TOPIC_PARTITION), "overlapping"))
    keys = [*BATCH, *TOPIC_PARTITION]
    readings = Window.partitionBy(*SOURCE_COORDINATES).orderBy("load_time", *BATCH)
    again = facts.join(shared, keys, "left_semi").withColumn("reading", F.row_number().over(readings))
    return facts.join(shared, keys, "left_anti").unionByName(again.filter("reading = 1").drop("reading"))
