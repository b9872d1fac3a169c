"""Option maps of connectors that need a broker or a database; none is started here."""

import pytest
from pyspark.errors import AnalysisException

from quotelake.operators import cleaning, modelling
from quotelake.plans import frames
from quotelake.schema import FACT_COLUMNS
from quotelake.sources import jdbc, kafka, workdir
from quotelake.streaming import job


# The connectors' option names and values here are fixed.

def test_kafka_source_options():
    options = kafka.source_options("broker:9092", **{"kafka.security.protocol": "SSL"})
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "stock_prices",
        "startingOffsets": "latest", "failOnDataLoss": "false",
        "kafka.isolation.level": "read_committed", "kafka.security.protocol": "SSL"}
    assert kafka.source_options("b", offsets_per_trigger=1000)["maxOffsetsPerTrigger"] == "1000"
    assert "maxOffsetsPerTrigger" not in kafka.source_options("b", offsets_per_trigger=None)
    assert kafka.source_options("b", starting="earliest")["startingOffsets"] == "earliest"


def test_kafka_batch_options_span_the_topic():
    options = kafka.batch_options("b", "t")
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")


def test_kafka_sink_options():
    assert kafka.sink_options("b", "t") == {
        "kafka.bootstrap.servers": "b", "topic": "t", "kafka.acks": "all",
        "kafka.enable.idempotence": "true", "kafka.compression.type": "snappy",
        "kafka.linger.ms": "10", "kafka.batch.size": "16384", "kafka.retries": "3"}


def test_kafka_is_asked_for_by_name(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.read_stream(spark, kafka.source_options("b"))


def test_jdbc_write_options():
    db = jdbc.postgres("host", "stocks", "me", "secret")
    options = jdbc.write_options(db, "fact_stock_prices", batch_rows=500, connections=4)
    assert options == {
        "url": "jdbc:postgresql://host:5432/stocks", "user": "me", "password": "secret",
        "driver": "org.postgresql.Driver", "stringtype": "unspecified",
        "reWriteBatchedInserts": "true", "dbtable": "fact_stock_prices",
        "batchsize": "500", "numPartitions": "4"}
    assert jdbc.write_options(db, "t", connections=1)["batchsize"] == "1000"
    assert "secret" not in repr(db)


def test_jdbc_partitioned_read_options():
    db = jdbc.postgres("host", "stocks", "me", "secret")
    options = jdbc.read_options(db, "t", "event_time", "2024-01-01", "2024-02-01", connections=8)
    assert (options["partitionColumn"], options["numPartitions"]) == ("event_time", "8")
    assert "partitionColumn" not in jdbc.read_options(db, "t")


def test_database_gets_symbols_merged_before_facts(spark, events, monkeypatch):
    clean = cleaning.accepted(job.flag_messages(frames.messages(events)))
    changes, facts = modelling.dim_changes(clean), modelling.fact_rows(clean)
    done = []
    monkeypatch.setattr(jdbc, "replace", lambda df, options: done.append(
        (options["dbtable"], options["truncate"], options["numPartitions"], df.columns, df.count())))
    monkeypatch.setattr(jdbc, "append", lambda df, options: done.append(
        (options["dbtable"], options["batchsize"], options["numPartitions"], df.columns, df.count())))
    jdbc.star_sink(jdbc.postgres("h", "d", "u", "p"), 16, done.append, batch_rows=50)(changes, facts)
    assert done == [
        ("dim_stock_staging", "true", "16", list(jdbc.DIM_COLUMNS), changes.count()),
        jdbc.merge_statement(),
        ("fact_stock_prices", "50", "16", list(FACT_COLUMNS), facts.count())]


def test_merge_updates_known_symbols_and_keeps_their_creation():
    text = jdbc.merge_statement("d", "s")
    assert text.startswith("INSERT INTO d (symbol, company_name, sector, created_at, updated_at) SELECT ")
    update = text.split("DO UPDATE SET ")[1]
    assert "company_name = excluded.company_name" in update and "sector = excluded.sector" in update
    assert "created_at" not in update and "d.updated_at <= excluded.updated_at" in update


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_workdir_uses_the_shared_folder():
    session = Session(spark_checkpoint_dir="hdfs://shared/ckpt/", spark_master="yarn")
    first, second = (workdir.new_workdir(session, "q") for _ in range(2))
    assert first.startswith("hdfs://shared/ckpt/quotelake/q-") and first != second


def test_workdir_never_uses_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workdir.new_workdir(Session(spark_master="yarn"), "q")
    assert "quotelake" in workdir.new_workdir(Session(spark_master="local[4]"), "q")
