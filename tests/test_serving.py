from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF
from plan import physical
from quotelake.operators import analytics, serving
from quotelake.plans import batch, frames

FACT = ("id long, symbol string, price decimal(10,2), volume long, day_high decimal(10,2), "
        "day_low decimal(10,2), change_percent decimal(5,2), event_time timestamp")


def fact(spark, *rows):
    return spark.createDataFrame([
        (i, s, Decimal(str(p)), v, None if h is None else Decimal(str(h)),
         None if l is None else Decimal(str(l)), Decimal(str(c)), t)
        for i, (s, p, v, h, l, c, t) in enumerate(rows)], FACT)


DAY = datetime(2024, 1, 1, 12)


def test_daily_summary_and_zero_bounds(spark):
    df = fact(spark, ("A", 10, 5, 0, 0, 1, DAY), ("A", 20, 7, 21, 9, 1, DAY + timedelta(hours=1)),
              ("A", 30, 1, 0, 0, 1, DAY + timedelta(days=1)))
    first = serving.daily_summary(df).orderBy("trade_date").first()
    assert first.asDict() == {
        "symbol": "A", "trade_date": date(2024, 1, 1), "num_transactions": 2, "avg_price": 15.0,
        "max_price": Decimal("20.00"), "min_price": Decimal("10.00"), "total_volume": 12,
        "highest_day_high": Decimal("21.00"), "lowest_day_low": Decimal("0.00")}
    rows = serving.daily_summary(df, zero_as_null=True).orderBy("trade_date").collect()
    assert [r.lowest_day_low for r in rows] == [Decimal("9.00"), None]


def test_partials_fold_to_the_summary(spark, events):
    quotes = frames.quotes(events)
    parts = [quotes.filter(F.col("volume") < 30), quotes.filter(F.col("volume") >= 30)]
    folded = serving.finish_daily(serving.merge_daily(
        serving.daily_partials(parts[0]).unionByName(serving.daily_partials(parts[1]))))
    whole = serving.daily_summary(quotes)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, whole.collect()))


def test_daily_on_date_defaults_to_today(spark):
    now = datetime.now()
    df = fact(spark, ("A", 1, 1, 1, 1, 1, now), ("A", 1, 1, 1, 1, 1, now - timedelta(days=3)))
    assert serving.daily_on_date(serving.daily_summary(df)).count() == 1


def test_dashboard_defaults_to_now_and_is_newest_first(spark):
    now = spark.sql("select cast(current_timestamp() as timestamp) t").first().t
    df = fact(spark, *[("A", i, 1, 1, 1, 1, now - timedelta(minutes=i * 25)) for i in range(1, 5)])
    dim = spark.createDataFrame([("A", "Alpha", "Tech")], "symbol string, company_name string, sector string")
    rows = serving.dashboard(df, dim).collect()
    assert [float(r.price) for r in rows] == [1.0, 2.0] and rows[0].company_name == "Alpha"


def test_views_answer_sql(spark):
    now = spark.sql("select current_timestamp() t").first().t
    df = fact(spark, ("A", 2, 1, 1, 1, 1, now - timedelta(minutes=1)))
    dim = spark.createDataFrame([("A", "Alpha", "Tech")], "symbol string, company_name string, sector string")
    serving.register_views(spark, df, dim, serving.daily_summary(df))
    assert spark.sql("SELECT * FROM vw_realtime_stock_dashboard").count() == 1
    assert spark.sql("SELECT num_transactions FROM mv_daily_stock_summary").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM dim_stock NATURAL JOIN fact_stock_prices").first()[0] == 1


def test_time_bound_reaches_the_scan(spark, tmp_path):
    rows = fact(spark, ("A", 1, 1, 1, 1, 1, DAY)).withColumn("event_date", F.to_date("event_time"))
    rows.write.partitionBy("event_date").parquet(f"{tmp_path}/fact")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    text = physical(serving.recent(stored, "1 HOUR", DAY))
    assert "GreaterThanOrEqual(event_time," in text
    assert "event_date" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert serving.recent(stored, "1 HOUR", DAY).count() == 1
    assert serving.recent(stored).count() == 0


def rows_read(df):
    """Rows that the scan of a plan without shuffles gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_time_bounds_skip_row_groups(spark, tmp_path):
    quotes = spark.range(100_000).select(
        "id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("event_time"))
    quotes.coalesce(1).write.option("parquet.block.size", 64 * 1024).parquet(f"{tmp_path}/fact")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    assert rows_read(serving.recent(stored, "1 HOUR", datetime(2023, 11, 16, 2, 0))) < 50_000
    last = stored.agg(F.max("event_time"))
    assert serving.recent(stored, "1 HOUR", last).count() == 3601
    assert "ReusedSubquery" in physical(serving.recent(stored, "1 HOUR", last)) or "GreaterThanOrEqual" in physical(
        serving.recent(stored, "1 HOUR", last)) or "ScalarSubquery" in physical(serving.recent(stored, "1 HOUR", last))


def test_sectors_outside_the_list_are_in_other(spark):
    df = fact(spark, ("A", 1, 1, 1, 1, 5, DAY), ("B", 1, 1, 1, 1, 7, DAY), ("C", 1, 1, 1, 1, 9, DAY))
    dim = spark.createDataFrame([("A", "Tech"), ("B", "Unknown"), ("C", None)], "symbol string, sector string")
    rows = {r.symbol: (r.Tech, r.other) for r in analytics.sector_matrix(df, dim, ["Tech"]).collect()}
    assert rows == {"A": (5.0, None), "B": (None, 7.0), "C": (None, 9.0)}


def test_symbol_and_date_predicates_reach_the_scan(spark, tmp_path):
    fact(spark, ("A", 1, 1, 1, 1, 1, DAY)).write.parquet(f"{tmp_path}/fact")
    stored = spark.read.parquet(f"{tmp_path}/fact")
    from quotelake.operators.ingest import symbol_filter
    assert "In(symbol, [A,B])" in physical(symbol_filter(stored, "A, B"))
    text = physical(analytics.volume_by_symbol(stored))
    assert "ReadSchema: struct<symbol:string,volume:bigint>" in text


def test_newest_breaks_ties_by_id(spark):
    df = fact(spark, ("A", 1, 1, 1, 1, 1, DAY), ("B", 2, 1, 1, 1, 1, DAY), ("C", 3, 1, 1, 1, 1, DAY))
    assert [r.symbol for r in serving.newest(df, 2).collect()] == ["C", "B"]
    assert "TakeOrderedAndProject" in physical(serving.newest(df, 2))


def test_latest_price_and_trend(spark):
    df = fact(spark, ("A", 1, 1, 1, 1, 5, DAY), ("A", 2, 1, 1, 1, 6, DAY),
              ("A", 9, 1, 1, 1, 7, DAY - timedelta(minutes=1)))
    latest = analytics.latest_price(df).first()
    assert (float(latest.price), float(latest.change_percent)) == (2.0, 6.0)
    trend = analytics.price_trend(df).orderBy("bucket").collect()
    assert [(float(r.first_price), float(r.last_price)) for r in trend] == [(9.0, 9.0), (1.0, 2.0)]


def test_the_later_offset_wins_among_equal_times(spark):
    df = fact(spark, ("A", 1, 1, 1, 1, 5, DAY), ("A", 2, 1, 1, 1, 6, DAY))
    df = df.withColumn("offset", 10 - F.col("id"))
    assert float(analytics.latest_price(df).first().price) == 1.0
    assert float(analytics.price_trend(df).first().last_price) == 1.0
    assert float(serving.newest(df, 1).first().price) == 1.0


def test_moving_average_by_dates_and_by_calendar(spark):
    days = [0, 1, 9]
    df = fact(spark, *[("A", 10 * (i + 1), 1, 1, 1, 1, DAY + timedelta(days=d)) for i, d in enumerate(days)])
    rows = analytics.moving_average(df, 7).orderBy("trade_date").collect()
    assert [r.moving_avg_price for r in rows] == [10.0, 15.0, 20.0]
    rows = analytics.moving_average(df, 7, calendar=True).orderBy("trade_date").collect()
    assert [r.moving_avg_price for r in rows] == [10.0, 15.0, 30.0]


def test_shares_without_volume_are_null(spark):
    df = fact(spark, ("A", 1, 0, 1, 1, 1, DAY))
    assert analytics.market_share(df).first().share is None


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
             "BatchEvalPython", "MapInPandas", "FlatMapGroups")


@pytest.mark.parametrize("name", sorted(n for n, q in batch.QUERIES.items() if q.__module__.endswith("batch")))
def test_plans_have_no_cross_join_and_no_python(spark, name):
    text = physical(batch.QUERIES[name](spark, SF))
    assert not [node for node in FORBIDDEN if node in text]


RAW_ROW_AGGREGATES = [
    "daily_summary", "daily_summary_parts", "symbol_totals", "price_trend", "latest_price",
    "volume_by_symbol", "market_share", "sector_performance", "sector_performance_parts",
    "sector_matrix", "risk_return", "moving_avg_7d", "gainers", "duplicate_keys",
    "throughput_windows", "latency_stats", "latency_stats_by_type", "latency_by_group",
    "latency_two_level", "dim_first_seen", "dim_upsert", "volume_over_time",
]


def reduces_before_shuffle(plan: str) -> bool:
    """Whether each scan of raw rows meets a partial aggregate before an exchange."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    for i, line in enumerate(lines):
        if "FileScan" not in line or "customer" in line or "part.parquet" in line:
            continue
        level, reduced = depth[i], False
        for j in range(i - 1, -1, -1):
            if depth[j] >= level:
                continue
            level = depth[j]
            reduced = reduced or "partial_" in lines[j]
            if "Exchange" in lines[j]:
                break
        if not reduced:
            return False
    return True


@pytest.mark.parametrize("name", RAW_ROW_AGGREGATES)
def test_facts_are_reduced_before_any_shuffle(spark, name):
    assert reduces_before_shuffle(physical(batch.QUERIES[name](spark, SF)))


@pytest.mark.parametrize("name", ["latest_price", "price_trend", "gainers", "losers", "dim_first_seen", "dim_upsert"])
def test_raw_facts_are_hashed_not_sorted(spark, name):
    text = physical(batch.QUERIES[name](spark, SF))
    below = text[text.rindex("Exchange hashpartitioning(symbol"):]
    assert "HashAggregate" in below and "SortAggregate" not in below and "Sort [" not in below


def test_the_shuffle_check_finds_raw_rows(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert not reduces_before_shuffle(physical(events.repartition(4, "user_id")))
    assert not reduces_before_shuffle(physical(events.repartition(4).groupBy("user_id").count()))
