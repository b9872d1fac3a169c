"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Timestamps of the message format carry no zone, so one zone is fixed for all jobs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default, INT96, has no statistics: bounds on time would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Fixed when the session is made. The first skips a stack walk per column expression,
# about half the time of building a wide plan in Python.
STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Stateful queries keep their state off the executor heap.
STATEFUL_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streams; the caller's settings stay as they are.

    A stateful query keeps the number of shuffle partitions of its first start, which is
    the caller's setting.
    """
    session = configure(spark.newSession())
    for key, value in STATEFUL_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


def build_session(app: str = "quotelake", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
