"""Streams against batch, over several files in any order; replays; state; progress."""

import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plan import physical
from quotelake.__main__ import arguments, start
from quotelake.operators import cleaning, health, modelling, serving
from quotelake.operators.ingest import parse_quotes
from quotelake.plans import frames, streams
from quotelake.schema import TOPIC
from quotelake.sources import files
from quotelake.streaming import job, metrics, queries, tables

NOW = {"availableNow": True}
WALL_CLOCK = ["processing_time", "load_time", "created_at", "updated_at"]


def rows(df):
    kept = sorted(c for c in df.columns if c not in WALL_CLOCK)
    return sorted(map(repr, df.select(*kept).collect()))


@pytest.fixture
def messages(events):
    return frames.messages(events)


@pytest.fixture
def topic(messages, folder):
    """The messages as four files whose modification order is shuffled."""
    path = f"{folder}/topic"
    files.write_topic_files(messages.repartition(4), path)
    parts = [f"{path}/{f}" for f in sorted(os.listdir(path)) if f.endswith(".parquet")]
    random.Random(7).shuffle(parts)
    for age, part in enumerate(parts):
        os.utime(part, (1_700_000_000 + age, 1_700_000_000 + age))
    assert len(parts) == 4
    return path


@pytest.fixture
def expected(messages):
    """The tables a batch run over all messages gives."""
    flagged = job.flag_messages(messages)
    clean = cleaning.accepted(flagged)
    facts = modelling.fact_rows(clean).withColumn("event_date", F.to_date("event_time"))
    return {"fact": facts, "dim": modelling.dim_changes(clean),
            "daily": serving.daily_summary(facts),
            "quarantine": cleaning.rejected(flagged).select(
                "reject_reason", "raw_value", "symbol", "processing_time",
                "topic", "partition", "offset")}


def stored(spark, star):
    return {"fact": tables.read_fact(spark, star), "dim": tables.read_dim(spark, star),
            "daily": tables.read_daily(spark, star),
            "quarantine": tables.read_quarantine(spark, star)}


def run_star(spark, topic, star, checkpoint, **options):
    query = job.start_star_job(
        files.stream_topic_files(spark, topic, files_per_trigger=1), star, checkpoint, NOW, **options)
    queries.run_available(query)
    return query


def assert_tables(spark, star, expected):
    for name, table in stored(spark, star).items():
        assert rows(table) == rows(expected[name]), name


def test_star_job_over_micro_batches_equals_batch(spark, topic, folder, expected):
    star = tables.Tables(f"{folder}/star")
    query = run_star(spark, topic, star, f"{folder}/checkpoint")
    assert_tables(spark, star, expected)
    batches = os.listdir(f"{star.quarantine}/query_id={query.id}")
    assert sum(b.startswith("batch_id=") for b in batches) == 4
    metrics = [p["observedMetrics"]["quotes"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(m["read"] for m in metrics) == 1000 == spark.read.parquet(topic).count()
    assert sum(m["rejected"] for m in metrics) == expected["quarantine"].count()


@pytest.mark.parametrize("failing_batch", [0, 2])
def test_a_batch_that_fails_after_its_write_leaves_no_duplicates(
        spark, topic, folder, expected, failing_batch):
    star, calls = tables.Tables(f"{folder}/star"), []

    def fail_once(changes, facts):
        calls.append({r.processing_time for r in facts.select("processing_time").distinct().collect()})
        if len(calls) == failing_batch + 1:
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        run_star(spark, topic, star, f"{folder}/checkpoint", after_write=fail_once)
    found = stored(spark, star)
    seen = found["fact"].count() + found["quarantine"].count()
    assert found["daily"].agg(F.sum("num_transactions")).first()[0] == found["fact"].count()
    assert 0 < seen < 1000
    run_star(spark, topic, star, f"{folder}/checkpoint", after_write=fail_once)
    assert len(calls) == 5
    assert calls[failing_batch] == calls[failing_batch + 1]  # the batch keeps its time
    assert_tables(spark, star, expected)


def files_below(path):
    return {f"{at}/{name}": os.stat(f"{at}/{name}").st_mtime_ns for at, _, names in os.walk(path)
            for name in names if name.endswith(".parquet")}


def test_a_batch_written_again_changes_nothing(spark, messages, folder, expected):
    star = tables.Tables(f"{folder}/star")
    for _ in range(2):
        job.write_star(job.flag_messages(messages), star, "q", 0)
        assert_tables(spark, star, expected)
    assert len({name.split("query_id=")[1].split("/")[0] for name in files_below(star.fact)}) == 1


def test_a_batch_replaces_only_the_dates_it_touches(spark, messages, folder, expected):
    star, day = tables.Tables(f"{folder}/star"), date(2024, 1, 15)
    early = messages.filter(F.to_date("timestamp") < day)
    late = messages.filter(F.to_date("timestamp") >= day)
    job.write_star(job.flag_messages(early), star, "q", 0)
    before = files_below(star.daily)
    job.write_star(job.flag_messages(late), star, "q", 1)
    after = files_below(star.daily)
    # An event time that fell out takes the broker's, so dates are those of the batch.
    assert before.items() <= after.items() and len(after) > len(before)
    for n in range(2, 5):  # further batches of one date: the date keeps one set of files
        job.write_star(job.flag_messages(messages.filter(F.to_date("timestamp") == day)), star, "q", n)
    kept = {k: v for k, v in files_below(star.daily).items() if f"trade_date={day}" not in k}
    assert kept == {k: v for k, v in after.items() if f"trade_date={day}" not in k}
    one_day = tables.read_daily(spark, star, day, day)
    assert len(one_day.inputFiles()) == 1
    again = rows(tables.read_daily(spark, star, day + timedelta(1)))
    assert again == rows(expected["daily"].filter(F.col("trade_date") > day))
    counted = one_day.agg(F.sum("num_transactions")).first()[0]
    assert counted == 4 * expected["daily"].filter(F.col("trade_date") == day).agg(F.sum("num_transactions")).first()[0]


def test_reads_of_a_day_list_its_directories_only(spark, topic, folder, expected):
    star, day = tables.Tables(f"{folder}/star"), date(2024, 1, 10)
    run_star(spark, topic, star, f"{folder}/checkpoint")
    facts = tables.read_fact(spark, star, day, day)
    assert facts.inputFiles() and all(f"event_date={day}" in name for name in facts.inputFiles())
    assert rows(facts) == rows(expected["fact"].filter(F.col("event_date") == day))
    assert rows(tables.read_daily(spark, star, day, day)) == rows(expected["daily"].filter(F.col("trade_date") == day))
    assert tables.read_fact(spark, star, date(2031, 1, 1)).count() == 0


def test_backfill_gathers_dates_into_few_files(spark, topic, folder, expected):
    def files_of(name, **options):
        star = tables.Tables(f"{folder}/{name}")
        query = job.start_star_job(
            files.stream_topic_files(spark, topic, bytes_per_trigger=2**40), star,
            f"{folder}/{name}-checkpoint", NOW, **options)
        queries.run_available(query)
        assert_tables(spark, star, expected)
        (batch,) = [p for p in query.recentProgress if p["numInputRows"]]
        assert batch["observedMetrics"]["quotes"]["read"] == 1000
        return len(tables.read_fact(spark, star).inputFiles())

    assert files_of("backfill", backfill=True) < files_of("live")


def test_backfill_gathers_daily_parts_by_date(spark, messages, folder, expected):
    star = tables.Tables(f"{folder}/star")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        job.write_star(job.flag_messages(messages), star, "q", 0, backfill=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    days = expected["fact"].select("event_date").distinct().count()
    assert days > 1 and len(files_below(star.daily_parts)) == days
    assert_tables(spark, star, expected)


def test_several_tasks_read_a_file_of_a_delivery(spark):
    text = F.concat(*(F.sha2((F.col("id") * 4 + n).cast("string"), 256) for n in range(4)))
    made = spark.range(0, 200_000, 1, 1).select(
        F.lit(None).cast("binary").alias("key"), text.cast("binary").alias("value"), F.lit("quotes").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"))
    folder = streams._topic(spark, "", "deliveries", made, "timestamp", "offset", late=False)
    for arrival in range(frames.ARRIVALS):
        read = spark.read.schema(TOPIC).parquet(f"{folder}/topic/arrival={arrival}")
        assert len(read.inputFiles()) == 1
        assert read.select(F.spark_partition_id()).distinct().count() >= 3
    every = spark.read.schema(TOPIC).parquet(f"{folder}/topic/arrival=*")
    assert made.exceptAll(every).isEmpty() and every.count() == 200_000


def test_a_lost_checkpoint_repeats_facts_and_rewrite_removes_them(spark, topic, folder, expected):
    star, fresh = tables.Tables(f"{folder}/star"), tables.Tables(f"{folder}/fresh")
    run_star(spark, topic, star, f"{folder}/first")
    run_star(spark, topic, star, f"{folder}/second")
    assert tables.read_fact(spark, star).count() == 2 * expected["fact"].count()
    assert rows(tables.read_dim(spark, star)) == rows(expected["dim"])
    tables.rewrite_tables(spark, star, fresh, drop_repeated_offsets=True)
    found = stored(spark, fresh)
    for name in ("fact", "dim", "daily"):
        assert rows(found[name]) == rows(expected[name]), name


def test_rewrite_keeps_the_tables_and_drops_deleted_rows(spark, topic, folder, expected):
    star, fresh = tables.Tables(f"{folder}/star"), tables.Tables(f"{folder}/fresh")
    run_star(spark, topic, star, f"{folder}/checkpoint")
    gone = expected["fact"].first().symbol
    tables.delete_symbol_rows(spark, star, gone)
    kept = {n: expected[n].filter(F.col("symbol") != gone) for n in ("fact", "daily")}
    for name, table in kept.items():
        assert rows(stored(spark, star)[name]) == rows(table)
    tables.rewrite_tables(spark, star, fresh)
    for name, table in kept.items():
        assert rows(stored(spark, fresh)[name]) == rows(table)
    assert not os.path.exists(fresh.deletes)


def test_rows_loaded_after_a_delete_stay(spark, topic, folder, expected):
    star = tables.Tables(f"{folder}/star")
    tables.delete_symbol_rows(spark, star, expected["fact"].first().symbol)
    run_star(spark, topic, star, f"{folder}/checkpoint")
    assert_tables(spark, star, expected)


def test_reads_before_any_batch_are_empty(spark, folder):
    found = stored(spark, tables.Tables(f"{folder}/none"))
    assert all(t.count() == 0 for t in found.values())


def test_fact_table_is_pruned_by_date(spark, topic, folder):
    star = tables.Tables(f"{folder}/star")
    run_star(spark, topic, star, f"{folder}/checkpoint")
    recent = serving.recent(tables.read_fact(spark, star), "1 HOUR", datetime(2024, 1, 30, 23))
    assert "event_date" in physical(recent).split("PartitionFilters: ")[1].split("]")[0]


def test_clean_stream_equals_batch(spark, topic, messages, folder):
    stream = cleaning.clean_quotes(parse_quotes(files.stream_topic_files(spark, topic, 1)))
    queries.run_available(queries.start_append(stream, f"{folder}/out", f"{folder}/c", NOW))
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(
        cleaning.clean_quotes(parse_quotes(messages)))


def test_text_twin(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "w") as out:
        out.write('{"symbol":"A","price":1.5}\n{bad\n{"symbol":"A","price":1.5}\n')
    stream = files.stream_text_files(spark, f"{folder}/in")
    assert stream.schema.names == TOPIC.names
    star = tables.Tables(f"{folder}/star")
    queries.run_available(job.start_star_job(stream, star, f"{folder}/c", NOW))
    assert tables.read_fact(spark, star).count() == 2
    assert tables.read_quarantine(spark, star).count() == 1
    fresh = tables.rewrite_tables(spark, star, tables.Tables(f"{folder}/fresh"), drop_repeated_offsets=True)
    assert tables.read_fact(spark, fresh).count() == 2  # equal lines are quotes of their own


def quote(**fields):
    base = {"symbol": "A", "price": 1.5, "volume": "1", "event_time": "2024-01-02T03:04:05"}
    return json.dumps(base | fields)


def run_text(spark, folder, lines, **options):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "w") as out:
        out.write("\n".join(lines) + "\n")
    star = tables.Tables(f"{folder}/star")
    queries.run_available(job.start_star_job(
        files.stream_text_files(spark, f"{folder}/in"), star, f"{folder}/c", NOW, **options))
    return star


def test_volumes_beyond_64_bits_add_up(spark, folder):
    large = 9 * 10**18
    star = run_text(spark, folder, [quote(volume=str(large)), quote(volume=str(large), price=2.0)])
    assert tables.read_daily(spark, star).first().total_volume == 2 * large


def test_rewrite_keeps_the_zero_rule(spark, folder):
    star = run_text(spark, folder, [quote(day_low=0.0), quote(day_low=1.2)], zero_as_null=True)
    for drop in (False, True):
        fresh = tables.Tables(f"{folder}/fresh{drop}")
        tables.rewrite_tables(spark, star, fresh, drop_repeated_offsets=drop, zero_as_null=True)
        assert float(tables.read_daily(spark, fresh).first().lowest_day_low) == 1.2


def clean_stream(spark, topic):
    return cleaning.clean_quotes(parse_quotes(files.stream_topic_files(spark, topic, 1)))


def test_first_seen_job_keeps_the_first_quote_of_each_symbol(spark, topic, messages, folder):
    queries.run_available(job.start_first_seen_job(
        clean_stream(spark, topic), f"{folder}/first", f"{folder}/c", NOW))
    clean = cleaning.clean_quotes(parse_quotes(messages))
    first = modelling.dim_first_seen(clean, ("event_time", "offset"))
    found = tables.read_first_seen(spark, f"{folder}/first")
    assert found.columns == ["symbol", "company_name", "sector", "updated_at"]
    assert rows(found) == rows(first)


def test_first_seen_within_a_watermark(spark, topic, messages, folder):
    first = queries.first_seen_within(clean_stream(spark, topic), "60 days")
    queries.run_available(queries.start_append(first, f"{folder}/out", f"{folder}/c", NOW))
    clean = cleaning.clean_quotes(parse_quotes(messages))
    assert spark.read.parquet(f"{folder}/out").count() == clean.select("symbol").distinct().count()


def test_enriched_stream_equals_batch(spark, topic, messages, folder):
    dim = frames.dim(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"))
    stream = queries.enrich_stream(
        clean_stream(spark, topic).drop("company_name", "sector"), dim)
    queries.run_available(queries.start_append(stream, f"{folder}/out", f"{folder}/c", NOW))
    batch = serving.with_dim(
        cleaning.clean_quotes(parse_quotes(messages)).drop("company_name", "sector"),
        dim, ["company_name", "sector"])
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(batch)


def test_throughput_in_complete_mode_has_every_window(spark, topic, messages):
    windows = queries.throughput_stream(files.stream_topic_files(spark, topic, 1))
    query = (windows.writeStream.outputMode("complete").format("memory")
             .queryName("window_counts").trigger(**NOW).start())
    queries.run_available(query)
    found = spark.table("window_counts")
    assert rows(found) == rows(health.throughput_windows(messages))
    assert rows(health.throughput_latest(found)) == rows(
        health.throughput_latest(health.throughput_windows(messages)))


def test_throughput_in_update_mode_keeps_late_rows(spark, topic, messages, folder):
    query = job.start_throughput_job(
        files.stream_topic_files(spark, topic, 1), f"{folder}/windows", f"{folder}/c", NOW,
        seconds=3600)
    queries.run_available(query)
    assert len(os.listdir(f"{folder}/windows/query_id={query.id}")) >= 4
    expected = rows(health.throughput_windows(messages, seconds=3600))
    assert rows(tables.read_throughput(spark, f"{folder}/windows")) == expected
    queries.run_available(job.start_throughput_job(  # the checkpoint is lost
        files.stream_topic_files(spark, topic, 1), f"{folder}/windows", f"{folder}/c2", NOW,
        seconds=3600))
    assert rows(tables.read_throughput(spark, f"{folder}/windows")) == expected


def test_throughput_of_a_query_that_goes_on_is_added(spark, messages, folder):
    """An old query ends, a new one begins at the latest offset, in the middle of a window."""
    for n, part in enumerate((messages.filter("offset < 500"), messages.filter("offset >= 500"))):
        files.write_topic_files(part, f"{folder}/topic{n}")
        queries.run_available(job.start_throughput_job(
            files.stream_topic_files(spark, f"{folder}/topic{n}"), f"{folder}/windows", f"{folder}/c{n}", NOW, seconds=86400))
    assert rows(tables.read_throughput(spark, f"{folder}/windows")) == rows(health.throughput_windows(messages, seconds=86400))


def test_throughput_in_append_mode_has_closed_windows(spark, topic, messages, folder):
    windows = queries.throughput_stream(
        files.stream_topic_files(spark, topic, 1), delay="40 days", seconds=3600)
    queries.run_available(queries.start_append(windows, f"{folder}/out", f"{folder}/c", NOW))
    assert spark.read.schema(windows.schema).parquet(f"{folder}/out").count() == 0
    windows = queries.throughput_stream(
        files.stream_topic_files(spark, topic), delay="1 hour", seconds=3600)
    queries.run_available(queries.start_append(windows, f"{folder}/o2", f"{folder}/c2", NOW))
    last = messages.agg(F.max("timestamp")).first()[0]
    closed = health.throughput_windows(messages, seconds=3600).filter(
        F.col("window_end") <= F.lit(last - timedelta(hours=1)))
    assert rows(spark.read.parquet(f"{folder}/o2")) == rows(closed)


def test_progress_reports(spark, topic, folder):
    star = tables.Tables(f"{folder}/star")
    query = run_star(spark, topic, star, f"{folder}/checkpoint")
    progress = queries.progress_frame(spark, query)
    assert progress.agg(F.sum("num_input_rows")).first()[0] == 1000
    stats = queries.progress_throughput(progress).first()
    assert 0 < stats.avg_throughput <= stats.peak_throughput


def test_rate_batches_feed_derived_columns(spark, folder):
    stream = health.derived_columns(files.rate_batches(spark, rows_per_batch=20))
    query = (stream.writeStream.format("memory").queryName("derived_rows")
             .option("checkpointLocation", f"{folder}/c").trigger(processingTime="0 seconds").start())
    try:
        while not query.lastProgress or query.lastProgress["batchId"] < 2:
            assert query.isActive
        query.stop()
    finally:
        queries.stop_all(spark)
    found = spark.table("derived_rows").filter("value = 7").first()
    assert (found.value_doubled, found.value_squared) == (14, 49.0)
    assert files.rate_stream(spark, 10).isStreaming


def test_command_line_runs_the_job(spark, topic, folder, expected):
    args = arguments(["--files", topic, "--tables", f"{folder}/star",
                      "--checkpoint", f"{folder}/checkpoint", "--once", "--files-per-trigger", "2",
                      "--backfill"])
    queries.run_available(start(spark, args))
    assert_tables(spark, tables.Tables(f"{folder}/star"), expected)


def test_when_one_query_ends_the_others_are_stopped(spark, topic, folder):
    spark.streams.resetTerminated()
    endless = (files.rate_stream(spark, 1).writeStream.format("noop")
               .option("checkpointLocation", f"{folder}/endless").start())
    queries.start_append(files.stream_topic_files(spark, topic), f"{folder}/out", f"{folder}/c", NOW)
    queries.run_until_any_ends(spark)
    assert not endless.isActive and not spark.streams.active


def deliveries(messages, late=True):
    """The rows of each delivery, as the registered queries get them."""
    placed = frames.arrivals(messages, "timestamp", "offset", late)
    return [placed.filter(F.col("arrival") == n).drop("arrival") for n in range(frames.ARRIVALS)]


def run_deliveries(spark, parts, folder, start):
    """One run of a query per delivery, with one checkpoint."""
    runs = []
    for part in parts:
        files.write_topic_files(part, f"{folder}/topic")
        runs.append(start(files.stream_topic_files(spark, f"{folder}/topic")))
        queries.run_available(runs[-1])
    return runs


def data_batches(runs):
    return sum(p["numInputRows"] > 0 for run in runs for p in run.recentProgress)


def test_windows_and_late_messages_are_all_messages(spark, messages, folder):
    parts = deliveries(messages)
    last = parts[-1]
    runs = run_deliveries(spark, [*parts[:-1], last.unionByName(last)], folder, lambda stream: queries.start_append(
        queries.once_per_window(stream, "12 hours", 3600), f"{folder}/out", f"{folder}/c", NOW))
    assert data_batches(runs) == 4
    late = sum(queries.late_rows(run) for run in runs)
    assert late > 0
    end = messages.agg(F.max("timestamp")).first()[0] - timedelta(hours=12)
    mark, on_time = None, None
    for part in parts:
        kept = part if mark is None else part.filter(F.col("timestamp") > F.lit(mark))
        on_time = kept if on_time is None else on_time.unionByName(kept)
        top = part.agg(F.max("timestamp")).first()[0]
        top = top.replace(microsecond=top.microsecond // 1000 * 1000) - timedelta(hours=12)
        mark = top if mark is None else max(mark, top)
    # The last delivery came twice: its second copies are dropped unless late once more.
    lost = sum(p.count() for p in parts) - on_time.count()
    twice = last.count() - on_time.join(last, "offset", "left_semi").count()
    assert late == lost + twice
    closed = health.throughput_windows(on_time, seconds=3600).filter(F.col("window_end") <= F.lit(end))
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(closed)


def test_the_listener_has_every_batch(spark, topic, folder, expected):
    listener = metrics.MetricsListener(spark, f"{folder}/metrics")
    spark.streams.addListener(listener)
    try:
        query = run_star(spark, topic, tables.Tables(f"{folder}/star"), f"{folder}/checkpoint")
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    found = metrics.read_metrics(spark, f"{folder}/metrics", "read", "rejected")
    assert found.count() == 4 and {r.query_id for r in found.collect()} == {str(query.id)}
    sums = found.agg(F.sum("read"), F.sum("rejected"), F.sum("num_input_rows")).first()
    assert tuple(sums) == (1000, expected["quarantine"].count(), 1000)
    assert not listener.failures and metrics.read_metrics(spark, f"{folder}/none").count() == 0


def test_a_renamed_symbol_has_its_new_name_from_its_batch_on(spark, folder):
    def part(sector, offset):
        body = quote(sector=sector, event_time=f"2024-01-0{offset + 1}T00:00:00")
        return spark.createDataFrame([(None, body.encode(), "t", 0, offset, datetime(2024, 1, 9))], TOPIC)

    star = tables.Tables(f"{folder}/star")

    def start(stream):
        return job.start_enriched_job(stream, star, f"{folder}/out", f"{folder}/c", NOW)

    runs = run_deliveries(spark, [part("old", 0), part("old", 1), part("new", 2), part("new", 3)], folder, start)
    assert data_batches(runs) == 4
    found = spark.read.parquet(f"{folder}/out")
    assert {r.offset: r.sector for r in found.collect()} == {0: "old", 1: "old", 2: "new", 3: "new"}
    replayed = tables.read_dim(spark, star, (str(runs[0].id), 1))
    assert [r.sector for r in replayed.collect()] == ["old"]


def test_sessions_leave_the_state(spark, folder):
    def part(*hours):
        return spark.createDataFrame([(None, quote(symbol=s, event_time=(datetime(2024, 1, 1) + timedelta(hours=h)).isoformat()).encode(),
                                       "t", 0, i, datetime(2024, 1, 1)) for i, (s, h) in enumerate(hours)], TOPIC)

    def start(stream):
        return queries.start_append(queries.symbol_sessions(cleaning.clean_quotes(parse_quotes(stream)), "10 hours", "1 hour"),
                                    f"{folder}/out", f"{folder}/c", NOW)

    runs = run_deliveries(spark, [
        part(*((f"S{i}", i % 5) for i in range(40))), part(("S1", 12), ("S2", 12)), part(("S3", 40)), part(("S1", 80), ("S4", 81))],
        folder, start)
    held = [metrics.state_rows(run, "sessionWindowStateStoreSaveExec", "numRowsTotal") for run in runs]
    assert data_batches(runs) == 4 and held[0][0] == 40 and held[-1][-1] == 2, held
    found = [(r.symbol, r.session_start.hour + 24 * (r.session_start.day - 1), r.quotes) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert len(found) == 42 and {("S1", 1, 1), ("S1", 12, 1), ("S2", 2, 2), ("S3", 40, 1)} <= set(found)


def test_sketches_of_batches_merge(spark, events, folder):
    from quotelake.operators import sketches
    timed = frames.latencies(events).select("event_type", "id", (F.col("id") * 37 % 1009).alias("latency_ms"))
    by, fractions = ("event_type",), {"p50": 0.5, "p99": 0.99}
    parts = [sketches.quantile_partials(timed.filter(F.col("id") % 4 == n), "latency_ms", by) for n in range(4)]
    whole = sketches.merged_quantiles(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), by, fractions)
    assert {r.event_type: r.n for r in whole.collect()} == {r.event_type: r["count"] for r in timed.groupBy(*by).count().collect()}
    held = sketches.quantiles_hold(timed, "latency_ms", by, whole, fractions).collect()
    assert held and all(r.p50_holds and r.p99_holds for r in held)
    off = whole.withColumn("p50", F.col("p99"))
    assert not any(r.p50_holds for r in sketches.quantiles_hold(timed, "latency_ms", by, off, fractions).collect())
    empty = timed.limit(0)
    assert sketches.merged_quantiles(sketches.quantile_partials(empty, "latency_ms", by), by, fractions).count() == 0
