import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plan import executed, physical
from quotelake.operators import modelling
from quotelake.plans import frames
from quotelake.schema import DIM
from quotelake.streaming import queries

T0 = datetime(2024, 1, 1)


def at(second):
    return T0.replace(second=second)


def dim_frame(spark, rows):
    """(symbol, name, sector, loaded second, event second, offset) -> dimension rows."""
    return spark.createDataFrame(
        [(s, n, sec, at(l), at(l), at(e), o) for s, n, sec, l, e, o in rows], DIM)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_first_seen_takes_earliest(spark):
    rows = [("A", "new", "x", at(5), 1), ("A", "old", "y", at(1), 9), ("A", "tie", "z", at(1), 10),
            ("B", "b", "x", at(3), 2)]
    df = spark.createDataFrame(
        rows, "symbol string, company_name string, sector string, event_time timestamp, id long")
    assert as_set(modelling.dim_first_seen(df, changed_at="event_time")) == {
        ("A", "old", "y", at(1)), ("B", "b", "x", at(3))}


def test_upsert_updates_inserts_and_keeps_created_at(spark):
    dim = dim_frame(spark, [("A", "old", "x", 1, 1, 1), ("K", "kept", "x", 1, 1, 2)])
    rows = dim_frame(spark, [("A", "new", "y", 7, 6, 3), ("A", "late", "z", 8, 5, 4),
                             ("N", "inserted", "z", 7, 7, 5)])
    out = {r.symbol: r for r in modelling.dim_upsert(dim, rows).collect()}
    assert (out["A"].company_name, out["A"].created_at, out["A"].updated_at) == ("new", at(1), at(7))
    assert out["K"].company_name == "kept" and out["N"].created_at == at(7)


dim_rows = st.lists(st.tuples(
    st.sampled_from("ABC"), st.sampled_from(["m", "n"]), st.sampled_from(["x", "y"]),
    st.integers(0, 9), st.integers(0, 9), st.integers(0, 5)), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(dim_rows, st.randoms())
def test_fold_ignores_order_grouping_and_repeats(spark, rows, rng):
    whole = as_set(modelling.merge_dim(dim_frame(spark, rows)))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    cut = rng.randint(0, len(rows))
    first = modelling.merge_dim(dim_frame(spark, shuffled[:cut] or shuffled[:1]))
    second = dim_frame(spark, shuffled[cut:] + shuffled[:1])
    again = modelling.dim_upsert(modelling.dim_upsert(first, second), second)
    assert as_set(again) == whole


def test_admitted_and_orphans_partition_facts(spark, events):
    fact = frames.quotes(events)
    dim = frames.dim(spark.read.parquet("/root/testdata/sf0.001/customer.parquet")).filter(
        "sector <> 'MACHINERY'")
    admitted = modelling.fact_admitted(fact, dim)
    orphans = modelling.fact_orphans(fact, dim)
    assert 0 < orphans.count() < fact.count()
    assert admitted.count() + orphans.count() == fact.count()
    assert admitted.select("symbol").intersect(orphans.select("symbol")).count() == 0


def test_duplicate_keys_and_delete(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (3, None)], "k int, symbol string")
    assert as_set(modelling.duplicate_keys(df, ["k"])) == {(1, 2)}
    assert {r.k for r in modelling.delete_symbol(df, "A").collect()} == {2, 3}


def test_ids_come_from_source_coordinates(spark):
    def ids(order):
        rows = spark.createDataFrame(order, "topic string, partition int, offset long")
        return {tuple(r) for r in rows.select("*", modelling.source_id().alias("id")).collect()}

    coordinates = [("quotes", p, o) for p in range(3) for o in range(50)]
    found = ids(coordinates)
    random.Random(1).shuffle(coordinates)
    assert ids(coordinates) == found and len({r[3] for r in found}) == 150


@pytest.fixture
def skewed(spark):
    """60,000 facts, a third of them of one symbol, and a dimension of 2,000 symbols."""
    hot = F.when(F.col("id") < 20_000, F.lit(0)).otherwise(F.col("id") % 2_000)
    fact = spark.range(60_000).select("id", F.concat(F.lit("S"), hot).alias("symbol"),
                                      F.repeat(F.lit("x"), 40).alias("pad"))
    dim = spark.range(0, 2_000).select(
        F.concat(F.lit("S"), F.col("id")).alias("symbol"), F.lit("sector").alias("sector"))
    return fact, dim


def no_broadcast_session(spark):
    """Joins shuffle, and a partition over 10 KB counts as skewed."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }.items():
        session.conf.set(key, value)
    return session


@pytest.fixture
def skewed_tables(skewed, tmp_path):
    fact, dim = skewed
    fact.repartition(8).write.parquet(f"{tmp_path}/fact")
    dim.withColumn("company_name", F.lit("c")).write.parquet(f"{tmp_path}/dim")


def test_hot_symbol_is_split_in_a_shuffled_join(spark, skewed_tables, tmp_path):
    session = no_broadcast_session(spark)
    admitted = modelling.fact_admitted(
        session.read.parquet(f"{tmp_path}/fact"), session.read.parquet(f"{tmp_path}/dim"))
    assert "skew=true" in executed(admitted)
    assert admitted.count() == 60_000


def test_hot_symbol_is_split_in_a_stream(spark, skewed_tables, tmp_path):
    session = no_broadcast_session(spark)
    stream = session.readStream.schema("id long, symbol string, pad string").parquet(f"{tmp_path}/fact")
    joined = queries.enrich_stream(stream, session.read.parquet(f"{tmp_path}/dim"))
    query = queries.start_append(
        joined, f"{tmp_path}/out", f"{tmp_path}/checkpoint", {"availableNow": True})
    queries.run_available(query)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 60_000
    assert "skew=true" in query._jsq.explainInternal(False)


def test_aggregates_reduce_before_the_shuffle(spark, skewed):
    fact, _ = skewed
    text = physical(modelling.duplicate_keys(fact, ["symbol"]))
    assert text.index("functions=[count") < text.index("Exchange") < text.index("partial_count")
