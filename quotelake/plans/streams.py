"""Streaming queries over the stand-in tables, each beside its SQL equivalent.

A query streams the events, derives quote messages from them, runs until all data at
hand is through, and returns the table the stream wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quotelake.operators import cleaning, sketches
from quotelake.operators.health import latency_stats
from quotelake.operators.ingest import parse_quotes
from quotelake.plans import frames
from quotelake.plans.batch import (
    CLEAN_COLUMNS, CLEAN_SQL, DAILY_SQL, DIM_SQL, FACT_SQL, FACT_TABLE_COLUMNS, FLAGGED_SQL, LATENCY_SQL, WINDOWS_SQL,
    query,
)
from quotelake.functions import latency_ms
from quotelake.schema import TOPIC
from quotelake.session import streaming_session
from quotelake.sources.workdir import new_workdir
from quotelake.streaming import job, metrics, queries, tables

AVAILABLE_NOW = {"availableNow": True}

# Bytes of input per micro-batch at most: what a large cluster parses and keeps at once.
BATCH_BYTES = 256 * 2**30
# A query's input is cut into at least four micro-batches.
BATCH_SHARE = 2 * frames.ARRIVALS
# Bytes of a row group in the deliveries: Spark's smallest split. A row group is read by one
# task; with the writer's default of 128 MiB one task would parse most of a micro-batch.
ROW_GROUP_BYTES = 4 * 2**20

Start = Callable[[DataFrame], StreamingQuery]


def _topic(spark: SparkSession, sf: str, name: str, rows: DataFrame, time: str, number: str,
           late: bool = True) -> str:
    """A work folder whose ``topic`` has the rows' deliveries, a folder each."""
    folder = new_workdir(spark, name)
    delivered = frames.arrivals(rows, time, number, late)
    delivered.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("arrival").parquet(f"{folder}/topic")
    return folder


def _message_topic(spark: SparkSession, sf: str, name: str, late: bool = True) -> str:
    return _topic(spark, sf, name, frames.messages(frames.table(spark, sf, "events")), "timestamp", "offset", late)


def _delivered(spark: SparkSession, folder: str, schema: StructType = TOPIC) -> DataFrame:
    """A stream of all deliveries, in micro-batches of a share of their bytes."""
    written = spark.read.parquet(f"{folder}/topic").select(F.col("_metadata.file_path"), F.col("_metadata.file_size"))
    size = written.distinct().agg(F.sum("file_size")).first()[0] or 0
    share = min(BATCH_BYTES, max(1, size // BATCH_SHARE))
    return (streaming_session(spark).readStream.schema(schema).option("maxBytesPerTrigger", share)
            .parquet(f"{folder}/topic/arrival=*"))


def _deliver(session: SparkSession, folder: str, start: Start, schema: StructType = TOPIC) -> list[StreamingQuery]:
    """Run a query on one delivery after the other, restarted from its checkpoint for each."""
    runs: list[StreamingQuery] = []
    for last in range(frames.ARRIVALS):
        runs.append(start(session.readStream.schema(schema).parquet(f"{folder}/topic/arrival=[0-{last}]")))
        queries.run_available(runs[-1])
    return runs


def _messages(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return _delivered(spark, _message_topic(spark, sf, name))


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _appended(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run an append stream to its end and read the table it wrote."""
    folder = new_workdir(spark, name)
    queries.run_available(queries.start_append(
        df, f"{folder}/out", f"{folder}/checkpoint", AVAILABLE_NOW))
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _star(spark: SparkSession, sf: str, name: str) -> tables.Tables:
    """Run the star-schema job to its end."""
    folder = _message_topic(spark, sf, name)
    target = tables.Tables(f"{folder}/tables")
    queries.run_available(job.start_star_job(
        _delivered(spark, folder), target, f"{folder}/checkpoint", AVAILABLE_NOW, backfill=True))
    return target


# The delivery that brings an event, as in frames.arrivals.
ARRIVAL_SQL = f"""span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
quarters AS (SELECT event_id, ts, {frames.ARRIVALS} * (epoch_us(ts) - lo) // (hi - lo + 1) AS quarter FROM events, span),
arrived AS (SELECT event_id, ts, CAST(least({frames.ARRIVALS - 1}, quarter + CASE WHEN event_id % 10 = 3 THEN 2 ELSE 0 END) AS BIGINT)
  AS arrival FROM quarters)"""


@query(f"WITH {CLEAN_SQL} SELECT * FROM clean")
def stream_clean(spark, sf):
    clean = cleaning.clean_quotes(parse_quotes(_messages(spark, sf, "stream_clean")))
    written = _appended(spark, clean.drop(
        "processing_time", "load_time", "topic", "partition"), "stream_clean")
    return _zoneless(written, "event_time")


@query(f"""WITH {CLEAN_SQL} SELECT symbol, company_name, sector FROM clean
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time, "offset") = 1""")
def stream_dim_first_seen(spark, sf):
    folder = _message_topic(spark, sf, "stream_dim_first_seen")
    clean = cleaning.clean_quotes(parse_quotes(_delivered(spark, folder)))
    queries.run_available(job.start_first_seen_job(
        clean, f"{folder}/first", f"{folder}/checkpoint", AVAILABLE_NOW))
    first = tables.read_first_seen(spark, f"{folder}/first")
    return first.select("symbol", "company_name", "sector")


DIM_LATEST_SQL = """dim AS (SELECT symbol, company_name, sector FROM clean
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, "offset" DESC) = 1)"""


@query(f"WITH {CLEAN_SQL}, {DIM_LATEST_SQL} SELECT * FROM dim")
def stream_dim_upsert(spark, sf):
    star = _star(spark, sf, "stream_dim_upsert")
    return tables.read_dim(spark, star).select("symbol", "company_name", "sector")


@query(f"""WITH {FACT_SQL}, {DIM_SQL}
SELECT fact.*, company_name, sector FROM fact JOIN dim USING (symbol)""")
def stream_enrich(spark, sf):
    events = frames.table(spark, sf, "events")
    folder = _topic(spark, sf, "stream_enrich", events, "ts", "event_id")
    facts = frames.quotes(_delivered(spark, folder, events.schema))
    dim = frames.dim(frames.table(facts.sparkSession, sf, "customer"))
    return _appended(spark, queries.enrich_stream(facts, dim), "stream_enrich")


THROUGHPUT_DELAY = "1 hour"


@query(f"""WITH {WINDOWS_SQL} SELECT * FROM windows
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_throughput(spark, sf):
    """The windows closed for the delay. Files come in no order of time: every window is
    kept by update-mode batches, however many, and the closed ones are chosen on reading."""
    closed = frames.table(spark, sf, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts")).agg(
        F.max("ts") - F.expr(f"INTERVAL {THROUGHPUT_DELAY}")).scalar()
    return _throughput(spark, sf, "stream_throughput").filter(F.col("window_end") <= closed)


def _throughput(spark: SparkSession, sf: str, name: str) -> DataFrame:
    folder = _message_topic(spark, sf, name)
    queries.run_available(job.start_throughput_job(
        _delivered(spark, folder).drop("key", "value"), f"{folder}/windows", f"{folder}/checkpoint",
        AVAILABLE_NOW))
    windows = tables.read_throughput(spark, f"{folder}/windows")
    return _zoneless(windows, "window_start", "window_end")


@query(f"WITH {WINDOWS_SQL} SELECT * FROM windows")
def stream_throughput_updates(spark, sf):
    """Every window, open ones too."""
    return _throughput(spark, sf, "stream_throughput_updates")


def _comparable_facts(facts: DataFrame) -> DataFrame:
    return _zoneless(facts.drop(
        "id", "processing_time", "load_time", "topic", "partition", "event_date"), "event_time")


@query(f"WITH {CLEAN_SQL} SELECT {FACT_TABLE_COLUMNS} FROM clean")
def stream_fact_replay(spark, sf):
    """After the last delivery, the second one is written again, as when a job dies between
    a batch's tables and its entry in the checkpoint."""
    folder = _message_topic(spark, sf, "stream_fact_replay")
    target = tables.Tables(f"{folder}/tables")
    runs = _deliver(streaming_session(spark), folder, lambda messages: job.start_star_job(
        messages, target, f"{folder}/checkpoint", AVAILABLE_NOW, backfill=True))
    second = spark.read.schema(TOPIC).parquet(f"{folder}/topic/arrival=1")
    job.write_star(job.flag_messages(second), target, runs[0].id, 1, backfill=True)
    return _comparable_facts(tables.read_fact(spark, target))


@query(f"""WITH {CLEAN_SQL}, {DIM_LATEST_SQL}
SELECT clean.* EXCLUDE (company_name, sector), dim.company_name, dim.sector
FROM clean JOIN dim ON clean.symbol = dim.symbol""")
def stream_star_schema(spark, sf):
    star = _star(spark, sf, "stream_star_schema")
    facts = _comparable_facts(tables.read_fact(spark, star))
    return queries.enrich_stream(facts, tables.read_dim(spark, star))


@query(f"WITH {CLEAN_SQL.replace('clean AS', 'fact AS')}, {DAILY_SQL} SELECT * FROM daily")
def daily_summary_incremental(spark, sf):
    return tables.read_daily(spark, _star(spark, sf, "daily_summary_incremental"))


@query(f"""WITH {CLEAN_SQL}
SELECT "offset", symbol, reject_reason FROM flagged WHERE reject_reason IS NOT NULL""")
def stream_quarantine(spark, sf):
    star = _star(spark, sf, "stream_quarantine")
    return tables.read_quarantine(spark, star).select("offset", "symbol", "reject_reason")


LATE_DELAY, LATE_WINDOW = "12 hours", 3600


@query(f"""WITH {ARRIVAL_SQL},
marks AS (SELECT arrival, date_trunc('millisecond', max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  - INTERVAL {LATE_DELAY} AS mark FROM arrived GROUP BY arrival),
judged AS (SELECT time_bucket(INTERVAL {LATE_WINDOW} SECOND, ts) AS window_start, coalesce(ts <= mark, false) AS late,
    (SELECT date_trunc('millisecond', max(ts)) - INTERVAL {LATE_DELAY} FROM events) AS final FROM arrived JOIN marks USING (arrival)),
kinds AS (SELECT CASE WHEN late THEN 'late' WHEN window_start + INTERVAL {LATE_WINDOW} SECOND <= final THEN 'closed' ELSE 'open' END AS kind,
    window_start FROM judged)
SELECT kind, CASE WHEN kind = 'closed' THEN window_start END AS window_start, count(*) AS records FROM kinds GROUP BY ALL""")
def stream_late_windows(spark, sf):
    """Closed windows, messages dropped as late, and messages of windows still open."""
    folder = _message_topic(spark, sf, "stream_late_windows")
    runs = _deliver(streaming_session(spark), folder, lambda messages: queries.start_append(
        queries.once_per_window(messages, LATE_DELAY, LATE_WINDOW), f"{folder}/out", f"{folder}/checkpoint", AVAILABLE_NOW))
    read = sum(p["numInputRows"] for run in runs for p in run.recentProgress)
    late = sum(queries.late_rows(run) for run in runs)
    closed = _zoneless(spark.read.parquet(f"{folder}/out"), "window_start").select(
        F.lit("closed").alias("kind"), "window_start", "records")
    rest = closed.agg((F.lit(read - late) - F.coalesce(F.sum("records"), F.lit(0))).alias("records")).select(F.lit("open").alias("kind"), "records")
    dropped = spark.range(1).select(F.lit("late").alias("kind"), F.lit(late).cast("long").alias("records"))
    return closed.unionByName(rest.unionByName(dropped), allowMissingColumns=True).filter("records > 0")


@query(f"""WITH {ARRIVAL_SQL}, {FLAGGED_SQL}
SELECT arrival AS batch_id, count(*) AS rows_read, count(reject_reason) AS rejected
FROM arrived JOIN flagged ON "offset" = event_id GROUP BY arrival""")
def stream_batch_metrics(spark, sf):
    """What a listener wrote of each batch of the star-schema job."""
    folder = _message_topic(spark, sf, "stream_batch_metrics")
    session = streaming_session(spark)
    listener = metrics.MetricsListener(session, f"{folder}/metrics")
    session.streams.addListener(listener)
    try:
        runs = _deliver(session, folder, lambda messages: job.start_star_job(
            messages, tables.Tables(f"{folder}/tables"), f"{folder}/checkpoint", AVAILABLE_NOW, backfill=True))
        for run in runs:
            listener.wait(run)
    finally:
        session.streams.removeListener(listener)
    return metrics.read_metrics(spark, f"{folder}/metrics", "read", "rejected").select(
        "batch_id", F.col("read").alias("rows_read"), "rejected")


@query(f"""WITH {ARRIVAL_SQL}, {CLEAN_SQL},
told AS (SELECT clean.*, arrival FROM clean JOIN arrived ON "offset" = event_id),
batches AS (SELECT DISTINCT arrival AS batch_id FROM arrived),
dim AS (SELECT batch_id, symbol, company_name, sector FROM told JOIN batches ON arrival <= batch_id
  QUALIFY row_number() OVER (PARTITION BY batch_id, symbol ORDER BY event_time DESC, "offset" DESC) = 1)
SELECT batch_id, "offset", symbol, price, event_time, dim.company_name, dim.sector
FROM told JOIN dim USING (symbol) WHERE batch_id = arrival""")
def stream_enrich_live(spark, sf):
    """Facts with the names that their symbol had when their batch was through."""
    folder = _message_topic(spark, sf, "stream_enrich_live")
    _deliver(streaming_session(spark), folder, lambda messages: job.start_enriched_job(
        messages, tables.Tables(f"{folder}/tables"), f"{folder}/enriched", f"{folder}/checkpoint", AVAILABLE_NOW))
    return _zoneless(spark.read.parquet(f"{folder}/enriched").select(
        F.col("batch_id").cast("long").alias("batch_id"), "offset", "symbol", "price", "event_time", "company_name", "sector"), "event_time")


IDLE, SESSION_DELAY = "1 day", "1 hour"


@query(f"""WITH {CLEAN_SQL},
gaps AS (SELECT symbol, event_time, coalesce(event_time > lag(event_time) OVER told + INTERVAL {IDLE}, true) AS new
  FROM clean WINDOW told AS (PARTITION BY symbol ORDER BY event_time, "offset")),
numbered AS (SELECT symbol, event_time, sum(CAST(new AS INTEGER)) OVER (PARTITION BY symbol ORDER BY event_time
  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM gaps)
SELECT symbol, min(event_time) AS session_start, max(event_time) + INTERVAL {IDLE} AS session_end, count(*) AS quotes
FROM numbered GROUP BY symbol, session
HAVING session_end <= (SELECT max(event_time) FROM clean) - INTERVAL {SESSION_DELAY}""")
def stream_symbol_sessions(spark, sf):
    """Sessions that the watermark has closed."""
    folder = _message_topic(spark, sf, "stream_symbol_sessions", late=False)

    def start(messages: DataFrame) -> StreamingQuery:
        quotes = cleaning.clean_quotes(parse_quotes(messages))
        return queries.start_append(queries.symbol_sessions(quotes, IDLE, SESSION_DELAY),
                                    f"{folder}/out", f"{folder}/checkpoint", AVAILABLE_NOW)

    _deliver(streaming_session(spark), folder, start)
    return _zoneless(spark.read.parquet(f"{folder}/out"), "session_start", "session_end")


SKETCHED = {"p95": 0.95, "p99": 0.99}


@query(f"""WITH {LATENCY_SQL}
SELECT event_type, count(*) AS n, quantile_cont(latency_ms, 0.95) AS p95_latency_ms, quantile_cont(latency_ms, 0.99) AS p99_latency_ms,
  true AS p95_holds, true AS p99_holds FROM lat GROUP BY event_type""")
def stream_latency_sketch(spark, sf):
    """Exact percentiles, and whether those of the stored sketches of all batches hold."""
    rows = frames.latencies(frames.table(spark, sf, "events"))
    folder = _topic(spark, sf, "stream_latency_sketch", rows, "event_time", "id")
    timed = _delivered(spark, folder, rows.schema).withColumn("latency_ms", latency_ms(F.col("event_time"), F.col("processing_time")))
    queries.run_available(job.start_sketch_job(
        timed, "latency_ms", ("event_type",), f"{folder}/sketches", f"{folder}/checkpoint", AVAILABLE_NOW))
    merged = sketches.merged_quantiles(spark.read.parquet(f"{folder}/sketches"), ("event_type",), SKETCHED)
    exact = rows.withColumn("latency_ms", latency_ms(F.col("event_time"), F.col("processing_time")))
    holds = sketches.quantiles_hold(exact, "latency_ms", ("event_type",), merged, SKETCHED)
    stats = latency_stats(exact, "latency_ms", ("event_type",)).select("event_type", "p95_latency_ms", "p99_latency_ms")
    return merged.select("event_type", "n").join(stats, "event_type").join(holds, "event_type")
