"""Gaps and repeats of offsets, bucketed tables, sketches of distinct values."""

import random

import pytest
from pyspark.sql import functions as F

from plan import physical
from quotelake.operators import layout, offsets, sketches
from quotelake.plans import batch
from quotelake.schema import NO_PARTITION

COORDINATES = "topic string, partition int, offset long"


def gaps(seen):
    """Runs of missing numbers between the first and the last."""
    out, ordered = [], sorted(set(seen))
    for a, b in zip(ordered, ordered[1:]):
        if b - a > 1:
            out.append((a + 1, b - 1, b - a - 1))
    return out


def found_gaps(messages, *args, **options):
    return sorted((r.topic, r.partition, r.from_offset, r.to_offset, r.missing)
                  for r in offsets.offset_gaps(messages, *args, **options).collect())


@pytest.mark.parametrize("width", [1, 7, 64, offsets.RANGE])
def test_gaps_of_any_range_width(spark, width):
    rng = random.Random(width)
    seen = [n for n in range(-50, 900) if rng.random() < 0.7] + [5000, 5001, 9000]
    rows = [("t", 0, n) for n in seen for _ in range(rng.randint(1, 3))] + [("t", 1, 4), ("u", 0, 8), ("u", 0, 3)]
    rows += [("file", NO_PARTITION, n) for n in (3, 900, 77)]
    messages = spark.createDataFrame(rows, COORDINATES).repartition(5)
    assert found_gaps(messages, width=width) == sorted([("t", 0, *g) for g in gaps(seen)] + [("u", 0, 4, 7, 4)])


def test_gaps_at_the_ends_and_of_silent_partitions(spark):
    messages = spark.createDataFrame([("t", 0, 5), ("t", 0, 6)], COORDINATES)
    expected = spark.createDataFrame([("t", 0, 3, 9), ("t", 1, 0, 4)], "topic string, partition int, first_offset long, last_offset long")
    assert found_gaps(messages, expected) == [("t", 0, 3, 4, 2), ("t", 0, 7, 9, 3), ("t", 1, 0, 4, 5)]
    assert found_gaps(messages.limit(0)) == []


def test_a_hot_partition_is_sorted_by_several_tasks(spark):
    messages = spark.range(200_000).filter("id % 1000 <> 7").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = messages.withColumn("range", F.floor(F.col("offset") / 4096)).repartition("topic", "partition", "range").select(
            F.spark_partition_id().alias("task")).groupBy("task").count().collect()
        assert len(tasks) > 1 and max(t["count"] for t in tasks) < 150_000
        plan = physical(offsets.offset_gaps(messages, width=4096))
        assert any("lag(" in line and "range#" in line for line in plan.splitlines())
        assert offsets.offset_gaps(messages, width=4096).agg(F.count("*"), F.sum("missing")).first() == (200, 200)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


FACTS = "query_id string, batch_id long, topic string, partition int, offset long, load_time timestamp"


def facts(spark, *batches):
    """Batches of (query, batch, partition, offsets, hour)."""
    rows = [(q, b, "t", p, o, hour) for q, b, p, numbers, hour in batches for o in numbers]
    frame = spark.createDataFrame(rows, "query_id string, batch_id long, topic string, partition int, offset long, hour int")
    return frame.select("query_id", "batch_id", "topic", "partition", "offset",
                        F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.col("hour"), F.lit(0), F.lit(0)).alias("load_time"))


def test_only_overlapping_intervals_are_found(spark):
    intervals = offsets.read_intervals(facts(
        spark, ("a", 0, 0, range(0, 10), 1), ("a", 1, 0, range(10, 20), 1), ("a", 2, 0, range(20, 100), 1), ("a", 3, 0, range(100, 110), 1),
        ("b", 0, 0, range(30, 40), 2), ("b", 1, 0, range(50, 60), 2), ("a", 1, 1, range(0, 9), 1), ("c", 0, NO_PARTITION, [5, 6], 1),
        ("c", 1, NO_PARTITION, [5], 1)))
    found = {(r.query_id, r.batch_id, r.partition) for r in offsets.overlapping(intervals).collect()}
    assert found == {("a", 2, 0), ("b", 0, 0), ("b", 1, 0)}


def test_repeated_reads_keep_the_first(spark):
    read = facts(spark, ("a", 0, 0, range(0, 10), 1), ("a", 1, 0, [10, 12, 14], 2), ("b", 0, 0, range(5, 14), 3), ("b", 1, 0, range(14, 20), 3),
                 ("a", 0, 1, [1, 2], 1), ("c", 0, NO_PARTITION, [3, 3], 1))
    kept = sorted((r.partition, r.offset, r.query_id) for r in offsets.drop_repeated_reads(read).collect())
    first = {**{(0, o): "b" for o in range(5, 20)}, **{(0, o): "a" for o in (*range(10), 10, 12, 14)}}
    assert kept == sorted([(p, o, q) for (p, o), q in first.items()] + [(1, 1, "a"), (1, 2, "a")] + [(NO_PARTITION, 3, "c")] * 2)
    assert offsets.drop_repeated_reads(read.limit(0)).count() == 0


def test_facts_of_other_batches_are_not_shuffled(spark, tmp_path):
    facts(spark, *(("a", n, 0, range(100 * n, 100 * n + 100), 1) for n in range(6)), ("b", 0, 0, range(550, 600), 2)).write.parquet(f"{tmp_path}/f")
    plan = physical(offsets.drop_repeated_reads(spark.read.parquet(f"{tmp_path}/f")))
    rest, again = (plan[plan.index(kind):] for kind in ("LeftAnti", "LeftSemi"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # that of the overlapping batches
    assert again and rest


# ---- bucketed tables

SF = "/root/testdata/sf0.001"


def test_bucketed_reads_have_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_latest", "bucketed_dashboard"):
            plan = physical(batch.QUERIES[name](spark, SF))
            assert "Bucketed: true" in plan and "hashpartitioning" not in plan, plan
        assert "SortMergeJoin" in physical(batch.bucketed_dashboard(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_scanned(df):
    """Rows that the scan of a plan without exchange gave out when it was run."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value()


def test_one_symbol_reads_one_bucket(spark):
    whole = batch._saved_fact(spark, SF)
    bucket = F.pmod(F.hash("symbol"), F.lit(16))
    same = whole.filter(bucket == F.pmod(F.hash(F.lit("S5")), F.lit(16))).count()
    found = whole.filter(F.col("symbol") == "S5")
    assert rows_scanned(found) == same < whole.count() / 4
    assert 0 < found.count() < same


def test_latest_per_symbol_takes_the_highest_id_of_a_time(spark):
    rows = [("A", 1, "2024-01-01 00:00:00", 5), ("A", 2, "2024-01-01 00:00:00", 6), ("A", 3, "2023-01-01 00:00:00", 7), ("B", 4, None, None)]
    fact = spark.createDataFrame(rows, "symbol string, id long, at string, price int").withColumn("event_time", F.to_timestamp_ntz("at"))
    got = {r.symbol: r.price for r in layout.latest_per_symbol(fact, "price").collect()}
    assert got == {"A": 6, "B": None}


# ---- distinct counts

def test_distinct_counts_merge_over_any_range(spark):
    rows = spark.range(60_000).select((F.col("id") % 9).alias("day"), (F.col("id") * 7919 % 20_011).alias("symbol"))
    partials = sketches.distinct_partials(rows, "symbol", ("day",))
    assert partials.count() == 9
    for first, last in ((0, 8), (2, 4), (5, 5)):
        chosen = F.col("day").between(first, last)
        about = sketches.merged_distinct(partials.filter(chosen), ()).first().n_distinct
        exact = rows.filter(chosen).select("symbol").distinct().count()
        assert abs(about - exact) <= 0.05 * exact
