"""Batch queries over the stand-in tables, each beside its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotelake.functions import latency_ms, whole_second_latency_ms
from quotelake.operators import analytics, cleaning, health, ingest, layout, modelling, offsets, serving, sketches
from quotelake.plans import frames
from quotelake.schema import MESSAGE_FIELDS
from quotelake.sources import files
from quotelake.sources.staging import stage_table
from quotelake.sources.workdir import new_workdir

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}

SECTORS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SUMMARY_DAY = date(2024, 1, 15)
WATCHLIST = "S1, S2 ,S3,S5,S8, S13"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""
    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return frames.table(spark, sf, "events")


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return frames.quotes(_events(spark, sf))


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    return frames.dim(frames.table(spark, sf, "customer"))


def _known_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that lacks many of the quoted symbols: there are fewer suppliers than users."""
    return frames.supplier_dim(frames.table(spark, sf, "supplier"))


def _part_fact(spark: SparkSession, sf: str) -> DataFrame:
    return frames.part_quotes(frames.table(spark, sf, "lineitem"))


def _parsed(spark: SparkSession, sf: str, **options) -> DataFrame:
    return ingest.parse_quotes(frames.messages(_events(spark, sf)), **options)


def _last_event(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("event_time"))


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the stand-in tables store them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# SQL of the frames the queries read.
WITH_K = "k AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)"
FACT_SQL = f"""{WITH_K},
p AS (SELECT *, CAST(value AS DECIMAL(10,2)) AS price FROM k),
fact AS (
  SELECT event_id AS id, 'S' || user_id AS symbol, price, k AS volume,
    CAST(price + k AS DECIMAL(10,2)) AS day_high, CAST(price - k AS DECIMAL(10,2)) AS day_low,
    CAST(k - 50 AS DECIMAL(10,2)) AS "change",
    CAST((k - 50) * 0.1 AS DECIMAL(5,2)) AS change_percent, ts AS event_time
  FROM p)"""
DIM_SQL = """dim AS (SELECT 'S' || c_custkey AS symbol, c_name AS company_name,
  c_mktsegment AS sector FROM customer)"""
KNOWN_SQL = """known AS (SELECT 'S' || s_suppkey AS symbol, s_name AS company_name,
  'Nation ' || s_nationkey AS sector FROM supplier)"""
DAILY_SQL = """daily AS (
  SELECT symbol, CAST(event_time AS DATE) AS trade_date, count(*) AS num_transactions,
    CAST(sum(price) AS DOUBLE) / count(*) AS avg_price,
    max(price) AS max_price, min(price) AS min_price,
    CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume,
    max(day_high) AS highest_day_high, min(day_low) AS lowest_day_low
  FROM fact GROUP BY ALL)"""
LATEST_SQL = """latest AS (
  SELECT * FROM fact
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, id DESC) = 1)"""
# Typed message rows with the reason each faulty one is rejected.
FLAGGED_SQL = f"""{WITH_K},
flagged AS (
  SELECT event_id AS "offset",
    CASE WHEN k IN (0, 1) THEN NULL WHEN k = 10 THEN rpad('S' || user_id, 21, 'X')
         WHEN k = 11 THEN '' ELSE 'S' || user_id END AS symbol,
    CASE WHEN k NOT IN (2, 4) THEN CAST(value AS DECIMAL(10,2)) END AS price,
    CASE k WHEN 3 THEN 0 WHEN 5 THEN 3000000000 WHEN 12 THEN 1000 ELSE k END AS volume,
    CAST(CAST(value AS DECIMAL(10,2)) + k AS DECIMAL(10,2)) AS day_high,
    CAST(CAST(value AS DECIMAL(10,2)) - k AS DECIMAL(10,2)) AS day_low,
    CAST(k - 50 AS DECIMAL(10,2)) AS "change",
    CASE WHEN k <> 9 THEN CAST((k - 50) * 0.1 AS DECIMAL(5,2)) END AS change_percent,
    date_trunc('second', ts) AS event_time,
    CASE WHEN k = 6 THEN 'S' || user_id ELSE 'Company S' || user_id END AS company_name,
    CASE WHEN k = 6 THEN 'Unknown' ELSE event_type END AS sector,
    CASE WHEN k IN (0, 1) THEN 'symbol_null' WHEN k = 11 THEN 'symbol_empty'
         WHEN k = 10 THEN 'symbol_long' WHEN k IN (2, 4) THEN 'price_null'
         WHEN k = 8 THEN 'event_time_bad' WHEN k = 13 THEN 'company_long'
         WHEN k = 14 THEN 'sector_long' END AS reject_reason
  FROM k)"""
CLEAN_COLUMNS = ('"offset", symbol, price, volume, day_high, day_low, "change", '
                 'change_percent, event_time, company_name, sector')
FACT_TABLE_COLUMNS = ('"offset", symbol, price, volume, day_high, day_low, "change", '
                      'change_percent, event_time')
CLEAN_SQL = f"""{FLAGGED_SQL},
clean AS (SELECT {CLEAN_COLUMNS} FROM flagged WHERE reject_reason IS NULL)"""
LATENCY_SQL = f"""{WITH_K},
lat AS (SELECT event_id AS id, user_id, event_type, ts AS event_time,
  ts + to_milliseconds(k * 37) AS processing_time, k * 37 AS latency_ms FROM k)"""
PART_FACT_SQL = """fact AS (
  SELECT 'P' || l_partkey AS symbol, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
    CAST(l_quantity AS BIGINT) AS volume, CAST(NULL AS DECIMAL(10,2)) AS day_high,
    CAST(NULL AS DECIMAL(10,2)) AS day_low, CAST(l_discount AS DECIMAL(5,2)) AS change_percent,
    l_shipdate AS event_time FROM lineitem)"""


# Messages: parse, clean, quarantine, vendor payloads, publish

@query(f"""WITH {WITH_K}
SELECT event_id AS "offset",
  CASE WHEN k IN (0, 1) THEN NULL WHEN k = 10 THEN rpad('S' || user_id, 21, 'X')
       WHEN k = 11 THEN '' ELSE 'S' || user_id END AS symbol,
  CASE WHEN k IN (0, 2) THEN NULL WHEN k = 4 THEN 1e9 ELSE value END AS price,
  CASE k WHEN 0 THEN NULL WHEN 3 THEN NULL WHEN 5 THEN '3000000000' WHEN 12 THEN '1000.0'
       ELSE CAST(k AS VARCHAR) END AS volume,
  CASE WHEN k <> 0 THEN CAST(k - 50 AS DOUBLE) END AS "change",
  CASE WHEN k = 0 THEN NULL WHEN k = 9 THEN 1234.5 ELSE CAST(k - 50 AS DOUBLE) / 10 END
    AS change_percent,
  CASE WHEN k <> 0 THEN value + k END AS day_high,
  CASE WHEN k <> 0 THEN value - k END AS day_low,
  CASE WHEN k IN (0, 7) THEN NULL WHEN k = 8 THEN 'bogus'
       WHEN k = 15 THEN strftime(ts, '%Y-%-m-%-dT%-H:%-M:%-S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS event_time,
  CASE WHEN k IN (0, 6) THEN NULL WHEN k = 13 THEN rpad('S' || user_id, 256, 'X')
       ELSE 'Company S' || user_id END AS company_name,
  CASE WHEN k IN (0, 6) THEN NULL WHEN k = 14 THEN rpad('S' || user_id, 101, 'X')
       ELSE event_type END AS sector
FROM k""")
def parse_quotes(spark, sf):
    return _parsed(spark, sf).select("offset", *MESSAGE_FIELDS)


@query(f"WITH {CLEAN_SQL} SELECT * FROM clean")
def clean_quotes(spark, sf):
    clean = cleaning.clean_quotes(_parsed(spark, sf))
    return _zoneless(
        clean.drop("processing_time", "load_time", "topic", "partition"), "event_time")


@query(f"""WITH {FLAGGED_SQL}
SELECT "offset", symbol, reject_reason FROM flagged WHERE reject_reason IS NOT NULL""")
def quarantine_quotes(spark, sf):
    bad = cleaning.quarantine_quotes(_parsed(spark, sf, keep_raw=True))
    return bad.select("offset", "symbol", "reject_reason")


@query(f"""WITH {WITH_K}
SELECT 'S' || user_id AS symbol,
  CASE WHEN k IN (2, 3) THEN 0 ELSE value END AS price,
  CASE WHEN k IN (0, 2, 3) THEN 0 ELSE k END AS volume,
  CASE WHEN k IN (2, 3) THEN 0.0 ELSE CAST(k - 50 AS DOUBLE) END AS "change",
  CASE WHEN k IN (1, 2, 3) THEN 0.0 ELSE CAST(k - 50 AS DOUBLE) / 10 END AS change_percent,
  CAST(0 AS DOUBLE) AS day_high, CAST(0 AS DOUBLE) AS day_low,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_time,
  'S' || user_id AS company_name, 'Unknown' AS sector
FROM k WHERE k NOT IN (4, 5)""")
def normalize_vendor(spark, sf):
    return ingest.normalize_vendor(frames.vendor_payloads(_events(spark, sf)))


@query(f"""WITH {WITH_K}
SELECT 'S' || user_id AS symbol,
  CASE k WHEN 4 THEN 'payload_malformed' ELSE 'price_bad' END AS reject_reason
FROM k WHERE k IN (4, 5)""")
def quarantine_vendor(spark, sf):
    return ingest.quarantine_vendor(frames.vendor_payloads(_events(spark, sf))).drop("payload")


@query(f"""WITH {FACT_SQL}
SELECT * FROM fact WHERE symbol IN ('S1', 'S2', 'S3', 'S5', 'S8', 'S13')""")
def symbol_filter(spark, sf):
    return ingest.symbol_filter(_fact(spark, sf), WATCHLIST)


@query(f"""WITH {FACT_SQL}
SELECT symbol AS "key", symbol, CAST(price AS DOUBLE) AS price, CAST(volume AS VARCHAR) AS volume,
  CAST("change" AS DOUBLE) AS "change", CAST(change_percent AS DOUBLE) AS change_percent,
  CAST(day_high AS DOUBLE) AS day_high, CAST(day_low AS DOUBLE) AS day_low,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS event_time,
  symbol AS company_name, 'Unknown' AS sector FROM fact""")
def publish_quotes(spark, sf):
    """Publish to the file twin of a topic and parse what arrived."""
    fact = _fact(spark, sf).withColumns({
        "event_time": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "company_name": F.col("symbol"), "sector": F.lit("Unknown")})
    path = new_workdir(spark, "publish_quotes")
    files.write_topic_files(ingest.publish_frame(fact), path)
    arrived = files.read_topic_files(spark, path)
    body = F.from_json(F.col("value").cast("string"), ingest.message_schema())
    return arrived.select(F.col("key").cast("string").alias("key"), F.inline(F.array(body)))


# Dimension, facts, integrity

NAMED_SQL = """named AS (SELECT event_id AS id, 'S' || user_id AS symbol,
  'S' || user_id || ' ' || event_type AS company_name, event_type AS sector, ts AS event_time
  FROM events)"""


@query(f"""WITH {NAMED_SQL}
SELECT symbol, company_name, sector, event_time AS updated_at FROM named
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time, id) = 1""")
def dim_first_seen(spark, sf):
    return modelling.dim_first_seen(
        frames.named_quotes(_events(spark, sf)), changed_at="event_time")


@query(f"""WITH {NAMED_SQL}, {KNOWN_SQL},
rows AS (
  SELECT symbol, company_name, sector, TIMESTAMP '2023-12-01 00:00:00' AS event_time,
    TIMESTAMP '2023-12-01 00:00:00' AS changed_at, -1 AS arrival FROM known
  UNION ALL
  SELECT symbol, company_name, sector, event_time, TIMESTAMP '2024-02-01 00:00:00', id FROM named)
SELECT symbol, company_name, sector,
  min(changed_at) OVER (PARTITION BY symbol) AS created_at, changed_at AS updated_at
FROM rows
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, arrival DESC) = 1""")
def dim_upsert(spark, sf):
    """One batch of quotes, loaded at one time, into a dimension that is there."""
    start = F.lit("2023-12-01 00:00:00").cast("timestamp_ntz")
    loaded = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    known = _known_dim(spark, sf).select(
        "*", start.alias("created_at"), start.alias("updated_at"),
        start.alias("last_event_time"), F.lit(-1).cast("bigint").alias("last_offset"))
    changes = modelling.dim_rows(
        frames.named_quotes(_events(spark, sf)).withColumn("loaded", loaded),
        changed_at="loaded", arrival="id")
    return modelling.dim_upsert(known, changes).drop("last_event_time", "last_offset")


@query(f"WITH {CLEAN_SQL} SELECT {FACT_TABLE_COLUMNS} FROM clean")
def fact_rows(spark, sf):
    facts = modelling.fact_rows(cleaning.clean_quotes(_parsed(spark, sf)))
    return _zoneless(
        facts.drop("id", "processing_time", "load_time", "topic", "partition"), "event_time")


@query(f"""WITH {FACT_SQL}, {KNOWN_SQL}
SELECT * FROM fact WHERE symbol IN (SELECT symbol FROM known)""")
def fact_admitted(spark, sf):
    return modelling.fact_admitted(_fact(spark, sf), _known_dim(spark, sf))


@query(f"""WITH {FACT_SQL}, {KNOWN_SQL}
SELECT * FROM fact WHERE symbol NOT IN (SELECT symbol FROM known)""")
def fact_orphans(spark, sf):
    return modelling.fact_orphans(_fact(spark, sf), _known_dim(spark, sf))


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return modelling.duplicate_keys(
        frames.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {FACT_SQL} SELECT * FROM fact WHERE symbol <> 'S7'")
def delete_symbol(spark, sf):
    return modelling.delete_symbol(_fact(spark, sf), "S7")


# Warehouse queries

@query("SELECT count(*) AS n FROM events")
def row_count(spark, sf):
    return serving.row_count(_fact(spark, sf))


@query(f"WITH {FACT_SQL}, {DAILY_SQL} SELECT * FROM daily")
def daily_summary(spark, sf):
    return serving.daily_summary(_fact(spark, sf))


@query(f"""WITH {FACT_SQL}, {DAILY_SQL}
SELECT * FROM daily WHERE trade_date = DATE '{SUMMARY_DAY}'""")
def daily_on_date(spark, sf):
    return serving.daily_on_date(serving.daily_summary(_fact(spark, sf)), SUMMARY_DAY)


@query(f"WITH {PART_FACT_SQL}, {DAILY_SQL} SELECT * FROM daily")
def daily_summary_parts(spark, sf):
    return serving.daily_summary(_part_fact(spark, sf))


@query(f"""WITH {FACT_SQL}
SELECT symbol, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
  CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume FROM fact GROUP BY symbol""")
def symbol_totals(spark, sf):
    return serving.symbol_totals(_fact(spark, sf))


@query(f"""WITH {PART_FACT_SQL}
SELECT symbol, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
  CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume FROM fact GROUP BY symbol""")
def symbol_totals_parts(spark, sf):
    return serving.symbol_totals(_part_fact(spark, sf))


@query(f"""WITH {FACT_SQL}, {DIM_SQL}
SELECT fact.*, company_name, sector FROM fact JOIN dim USING (symbol)
WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
ORDER BY event_time DESC""")
def dashboard_1h(spark, sf):
    fact = _fact(spark, sf)
    return serving.dashboard(fact, _dim(spark, sf), as_of=_last_event(fact))


@query(f"""WITH {FACT_SQL}
SELECT * FROM fact WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def recent_1h(spark, sf):
    fact = _fact(spark, sf)
    return serving.recent(fact, "1 HOUR", _last_event(fact))


@query(f"""WITH {FACT_SQL}, {DIM_SQL}
SELECT fact.*, company_name FROM fact JOIN dim USING (symbol)
WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def fact_dim_1d(spark, sf):
    fact = _fact(spark, sf)
    return serving.recent_with_company(fact, _dim(spark, sf), "1 DAY", _last_event(fact))


@query(f"WITH {FACT_SQL} SELECT * FROM fact ORDER BY event_time DESC, id DESC LIMIT 1000")
def latest_1000(spark, sf):
    return serving.newest(_fact(spark, sf), 1000)


# Analytics

@query(f"""WITH {FACT_SQL}
SELECT symbol, date_trunc('hour', event_time) AS bucket,
  CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
  min(price) AS min_price, max(price) AS max_price,
  first(price ORDER BY event_time, id) AS first_price,
  last(price ORDER BY event_time, id) AS last_price
FROM fact GROUP BY symbol, date_trunc('hour', event_time)""")
def price_trend(spark, sf):
    return analytics.price_trend(_fact(spark, sf))


@query(f"""WITH {FACT_SQL}, {LATEST_SQL}
SELECT symbol, price, change_percent, event_time, id FROM latest""")
def latest_price(spark, sf):
    return analytics.latest_price(_fact(spark, sf))


@query(f"""WITH {FACT_SQL}
SELECT symbol, CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume FROM fact GROUP BY symbol""")
def volume_by_symbol(spark, sf):
    return analytics.volume_by_symbol(_fact(spark, sf))


@query(f"""WITH {FACT_SQL}, {DAILY_SQL}
SELECT symbol, trade_date, total_volume,
  CAST(sum(total_volume) OVER (PARTITION BY symbol ORDER BY trade_date) AS DECIMAL(38,0))
    AS running_volume
FROM daily""")
def volume_over_time(spark, sf):
    return analytics.volume_over_time(_fact(spark, sf))


@query(f"""WITH {FACT_SQL}, v AS (
  SELECT symbol, CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume FROM fact GROUP BY symbol)
SELECT symbol, total_volume,
  CAST(total_volume AS DOUBLE) / (SELECT CAST(sum(total_volume) AS DOUBLE) FROM v) AS share
FROM v""")
def market_share(spark, sf):
    return analytics.market_share(_fact(spark, sf))


@query(f"""WITH {DIM_SQL}
SELECT sector, count(*) AS num_symbols,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM dim) AS share FROM dim GROUP BY sector""")
def sector_distribution(spark, sf):
    return analytics.sector_distribution(_dim(spark, sf))


SECTOR_COLUMNS = ", ".join(
    f"max(CASE WHEN sector = '{s}' THEN average END) AS \"{s}\"" for s in SECTORS[:-1])


@query(f"""WITH {FACT_SQL}, {DIM_SQL}, s AS (
  SELECT symbol, sector, CAST(sum(change_percent) AS DOUBLE) / count(change_percent) AS average
  FROM fact JOIN dim USING (symbol) GROUP BY ALL)
SELECT symbol, {SECTOR_COLUMNS}, max(CASE WHEN sector = '{SECTORS[-1]}' THEN average END) AS other
FROM s GROUP BY symbol""")
def sector_matrix(spark, sf):
    """A column for each sector but one, which is in ``other``."""
    return analytics.sector_matrix(_fact(spark, sf), _dim(spark, sf), SECTORS[:-1])


SECTOR_PERFORMANCE_SQL = """
SELECT sector, CAST(sum(change_percent) AS DOUBLE) / count(change_percent) AS avg_change_percent,
  CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume, count(*) AS num_transactions
FROM fact JOIN dim USING (symbol) GROUP BY sector"""


@query(f"WITH {FACT_SQL}, {DIM_SQL} {SECTOR_PERFORMANCE_SQL}")
def sector_performance(spark, sf):
    return analytics.sector_performance(_fact(spark, sf), _dim(spark, sf))


@query(f"""WITH {PART_FACT_SQL}, dim AS (
  SELECT 'P' || p_partkey AS symbol, p_brand AS sector FROM part) {SECTOR_PERFORMANCE_SQL}""")
def sector_performance_parts(spark, sf):
    return analytics.sector_performance(
        _part_fact(spark, sf), frames.part_dim(frames.table(spark, sf, "part")))


@query(f"""WITH {FACT_SQL}
SELECT symbol, round(stddev_samp(CAST(change_percent AS DOUBLE)), 6) AS risk,
  round(avg(CAST(change_percent AS DOUBLE)), 6) AS mean_return FROM fact GROUP BY symbol""")
def risk_return(spark, sf):
    return analytics.risk_return(_fact(spark, sf))


def _moving_sql(frame: str) -> str:
    return f"""WITH {FACT_SQL}, d AS (
  SELECT symbol, CAST(event_time AS DATE) AS trade_date, count(*) AS n, sum(price) AS total
  FROM fact GROUP BY ALL)
SELECT symbol, trade_date,
  CAST(sum(total) OVER w AS DOUBLE) / sum(n) OVER w AS moving_avg_price
FROM d WINDOW w AS (PARTITION BY symbol ORDER BY trade_date {frame})"""


@query(_moving_sql("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"))
def moving_avg_7d(spark, sf):
    return analytics.moving_average(_fact(spark, sf), 7)


@query(_moving_sql("RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW"))
def moving_avg_7d_calendar(spark, sf):
    return analytics.moving_average(_fact(spark, sf), 7, calendar=True)


@query(f"""WITH {FACT_SQL}, {LATEST_SQL} SELECT symbol, change_percent, price FROM latest
ORDER BY change_percent DESC NULLS LAST, symbol LIMIT 10""")
def gainers(spark, sf):
    return analytics.gainers(_fact(spark, sf), 10)


@query(f"""WITH {FACT_SQL}, {LATEST_SQL} SELECT symbol, change_percent, price FROM latest
ORDER BY change_percent ASC NULLS LAST, symbol LIMIT 10""")
def losers(spark, sf):
    return analytics.losers(_fact(spark, sf), 10)


# Stream health over stored events

@query("""SELECT event_id, value, value * 2 AS value_doubled, pow(value, 2) AS value_squared
FROM events""")
def derived_columns(spark, sf):
    return health.derived_columns(_events(spark, sf).select("event_id", "value"))


WINDOWS_SQL = """windows AS (
  SELECT time_bucket(INTERVAL 10 SECONDS, ts) AS window_start,
    time_bucket(INTERVAL 10 SECONDS, ts) + INTERVAL 10 SECONDS AS window_end, count(*) AS records
  FROM events GROUP BY ALL)"""


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return health.throughput_windows(_events(spark, sf), "ts")


@query(f"WITH {WINDOWS_SQL} SELECT * FROM windows")
def throughput_windows(spark, sf):
    return _windows(spark, sf)


@query(f"""WITH {WINDOWS_SQL}
SELECT window_end, records, records / 10.0 AS records_per_second
FROM windows ORDER BY window_end DESC LIMIT 1""")
def throughput_latest(spark, sf):
    return health.throughput_latest(_windows(spark, sf))


@query(f"""WITH {WINDOWS_SQL}
SELECT count(*) AS samples, CAST(sum(records) AS BIGINT) AS total_records,
  CAST(sum(records) AS DOUBLE) / count(*) / 10 AS avg_throughput,
  CAST(max(records) AS DOUBLE) / 10 AS peak_throughput,
  CAST(sum(records) AS DOUBLE) / count(*) / 10 * 1024 / 1048576 AS avg_mb_per_second
FROM windows""")
def throughput_stats(spark, sf):
    return health.throughput_stats(_windows(spark, sf))


def _latencies(spark: SparkSession, sf: str) -> DataFrame:
    rows = frames.latencies(_events(spark, sf))
    return rows.withColumn("latency_ms", latency_ms(F.col("event_time"), F.col("processing_time")))


@query(f"""WITH {LATENCY_SQL}
SELECT id, event_time, processing_time,
  (epoch(date_trunc('second', processing_time)) - epoch(date_trunc('second', event_time)))::BIGINT
    * 1000 AS latency_ms
FROM lat ORDER BY event_time DESC, id DESC LIMIT 100""")
def latency_latest_100(spark, sf):
    rows = frames.latencies(_events(spark, sf)).select(
        "id", "event_time", "processing_time",
        whole_second_latency_ms(F.col("event_time"), F.col("processing_time")).alias("latency_ms"))
    return _zoneless(health.latest_by_time(rows, "event_time", "id"), "event_time", "processing_time")


@query(f"""WITH {LATENCY_SQL}, newest AS (
  SELECT (epoch(date_trunc('second', processing_time)) - epoch(date_trunc('second', event_time)))::BIGINT
    * 1000 AS latency_ms FROM lat ORDER BY event_time DESC, id DESC LIMIT 100)
SELECT avg(latency_ms) AS avg_latency_ms, max(latency_ms) AS max_latency_ms,
  min(latency_ms) AS min_latency_ms FROM newest""")
def latency_latest_100_stats(spark, sf):
    rows = frames.latencies(_events(spark, sf)).select(
        "id", "event_time",
        whole_second_latency_ms(F.col("event_time"), F.col("processing_time")).alias("latency_ms"))
    return health.latest_stats(rows, "event_time", "id")


LATENCY_STATS_SQL = """CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
  round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms,
  max(latency_ms) AS max_latency_ms, min(latency_ms) AS min_latency_ms FROM lat"""


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        c: F.round(c, 6) for c in ("p95_latency_ms", "p99_latency_ms")})


@query(f"WITH {LATENCY_SQL} SELECT {LATENCY_STATS_SQL}")
def latency_stats(spark, sf):
    return _rounded(health.latency_stats(_latencies(spark, sf)))


@query(f"WITH {LATENCY_SQL} SELECT event_type, {LATENCY_STATS_SQL} GROUP BY event_type")
def latency_stats_by_type(spark, sf):
    return _rounded(health.latency_stats(_latencies(spark, sf), by=("event_type",)))


@query(f"""WITH {LATENCY_SQL}
SELECT event_type, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms,
  min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms
FROM lat GROUP BY event_type""")
def latency_by_group(spark, sf):
    return health.latency_by_group(_latencies(spark, sf), "event_type")


@query(f"""WITH {LATENCY_SQL}, w AS (
  SELECT user_id, avg(latency_ms) AS a, sum(latency_ms) AS t FROM lat GROUP BY user_id)
SELECT count(*) AS num_workers, round(avg(a), 6) AS avg_response_time_ms,
  CAST(sum(t) AS BIGINT) AS total_execution_time_ms FROM w""")
def latency_two_level(spark, sf):
    return health.latency_two_level(_latencies(spark, sf), "user_id")


# Offsets: gaps and repeated reads

# Messages of the first so many k are lost, and the topic has two partitions, one with most.
LOST = 7


@query(f"""WITH {WITH_K},
seen AS (SELECT CASE WHEN user_id % 5 = 0 THEN 1 ELSE 0 END AS "partition", event_id AS o FROM k WHERE k >= {LOST}
  UNION ALL SELECT p, unnest([-1, (SELECT max(event_id) + 1 FROM events)]) FROM (VALUES (0), (1)) t(p)),
steps AS (SELECT "partition", lag(o) OVER (PARTITION BY "partition" ORDER BY o) AS before, o FROM seen)
SELECT 'quotes' AS topic, "partition", before + 1 AS from_offset, o - 1 AS to_offset, o - before - 1 AS missing
FROM steps WHERE o - before > 1""")
def offset_gaps(spark, sf):
    events = _events(spark, sf)
    arrived = events.filter(frames.k_number() >= LOST)
    hot = F.when(F.col("user_id") % 5 == 0, 1).otherwise(0)
    seen = frames.messages(arrived, hot)
    expected = spark.range(2).select(
        F.lit("quotes").alias("topic"), F.col("id").cast("int").alias("partition"), F.lit(0).cast("long").alias("first_offset"),
        events.agg(F.max("event_id")).scalar().alias("last_offset"))
    return offsets.offset_gaps(seen, expected, width=1000)


# The first reading ends after eight tenths of the topic, the second begins after five.
@query(f"""WITH {CLEAN_SQL}
SELECT {FACT_TABLE_COLUMNS}, CASE WHEN "offset" < (SELECT max(event_id) * 8 // 10 FROM events) THEN 'first' ELSE 'second' END AS query_id
FROM clean""")
def repeated_reads(spark, sf):
    facts = modelling.fact_rows(cleaning.clean_quotes(_parsed(spark, sf)))
    last = _events(spark, sf).agg(F.max("event_id").alias("last"))
    begin = last.select(F.expr("last * 5 div 10")).scalar()
    first = facts.filter(F.col("offset") < last.select(F.expr("last * 8 div 10")).scalar()).select(
        "*", F.lit("first").alias("query_id"), F.floor(F.col("offset") / 1000).alias("batch_id"))
    second = facts.filter(F.col("offset") >= begin).withColumn(
        "load_time", F.col("load_time") + F.expr("INTERVAL 1 HOUR")).select(
        "*", F.lit("second").alias("query_id"), F.floor((F.col("offset") - begin) / 700).alias("batch_id"))
    kept = offsets.drop_repeated_reads(first.unionByName(second))
    return _zoneless(kept.drop("id", "processing_time", "load_time", "topic", "partition", "batch_id"), "event_time")


# Tables bucketed by symbol

def _saved(df: DataFrame, name: str, *order: str) -> DataFrame:
    return layout.save_bucketed(df, f"quotelake_{name}_{uuid4().hex}", 16, "symbol", *order)


def _saved_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _saved(_fact(spark, sf), "fact", "event_time")


@query(f"WITH {FACT_SQL}, {LATEST_SQL} SELECT symbol, event_time, price, volume FROM latest")
def bucketed_latest(spark, sf):
    return layout.latest_per_symbol(_saved_fact(spark, sf), "price", "volume")


@query(f"""WITH {FACT_SQL}, {DIM_SQL}
SELECT fact.*, company_name, sector FROM fact JOIN dim USING (symbol)
WHERE event_time >= (SELECT max(event_time) FROM fact) - INTERVAL 7 DAY""")
def bucketed_dashboard(spark, sf):
    fact, dim = _saved_fact(spark, sf), _saved(_dim(spark, sf), "dim")
    return layout.with_bucketed_dim(serving.recent(fact, "7 DAY", _last_event(fact)), dim, ["company_name", "sector"])


@query(f"WITH {FACT_SQL} SELECT id, price, event_time FROM fact WHERE symbol = 'S5'")
def bucketed_symbol(spark, sf):
    return _saved_fact(spark, sf).filter(F.col("symbol") == "S5").select("id", "price", "event_time")


# Mergeable distinct counts

SKETCH_DAYS = (date(2024, 1, 8), date(2024, 1, 21))


@query(f"""WITH {FACT_SQL}, {DIM_SQL}
SELECT sector, count(DISTINCT symbol) AS n_symbols, true AS within_5_percent FROM fact JOIN dim USING (symbol)
WHERE CAST(event_time AS DATE) BETWEEN '{SKETCH_DAYS[0]}' AND '{SKETCH_DAYS[1]}' GROUP BY sector""")
def distinct_symbols_sketch(spark, sf):
    """Symbols traded per sector in two weeks: exact, beside the union of the days' stored sketches."""
    traded = _fact(spark, sf).select("symbol", F.to_date("event_time").alias("trade_date")).distinct()
    named = serving.with_dim(traded, _dim(spark, sf), ["sector"])
    days = stage_table(sketches.distinct_partials(named, "symbol", ("trade_date", "sector")), "distinct-symbols")
    within = F.col("trade_date").between(*map(F.lit, SKETCH_DAYS))
    about = sketches.merged_distinct(days.filter(within), ("sector",), "about")
    exact = named.filter(within).groupBy("sector").agg(F.count_distinct("symbol").alias("n_symbols"))
    return exact.join(about, "sector").select(
        "sector", "n_symbols", (F.abs(F.col("about") - F.col("n_symbols")) <= 0.05 * F.col("n_symbols")).alias("within_5_percent"))
