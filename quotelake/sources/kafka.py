"""Kafka topics as streams, tables and sinks. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: topic of the quote stream.
DEFAULT_TOPIC = "stock_prices"


def source_options(servers: str, topic: str = DEFAULT_TOPIC, starting: str = "latest",
                   offsets_per_trigger: int | None = None,
                   fail_on_data_loss: bool = False,
                   isolation: str = "read_committed", **extra: str) -> dict[str, str]:
    """Options of a streaming topic scan.

    ``starting`` counts on the first start only; later the checkpoint owns the offsets.
    ``offsets_per_trigger`` bounds a micro-batch; by default it takes all that is there, so
    that no constant holds the stream back. Set it to what the executors parse in one
    trigger interval when a start has much to catch up on.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "kafka.isolation.level": isolation,
        **extra,
    }
    if offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(offsets_per_trigger)
    return options


def batch_options(servers: str, topic: str = DEFAULT_TOPIC, **extra: str) -> dict[str, str]:
    """Options of a scan over a whole topic, from its earliest to its latest offset."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        **extra,
    }


def sink_options(servers: str, topic: str = DEFAULT_TOPIC, acks: str = "all",
                 idempotence: bool = True, compression: str = "snappy", linger_ms: int = 10,
                 batch_size: int = 16384, retries: int = 3, **extra: str) -> dict[str, str]:
    """Options of a durable, idempotent topic writer."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.enable.idempotence": str(idempotence).lower(),
        "kafka.compression.type": compression,
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_size),
        "kafka.retries": str(retries),
        **extra,
    }


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The whole topic as a table; count it to drain it."""
    return spark.read.format("kafka").options(**options).load()


def write_topic(messages: DataFrame, options: dict[str, str]) -> None:
    messages.write.format("kafka").options(**options).save()


def publish_stream(messages: DataFrame, options: dict[str, str], checkpoint: str):
    return (
        messages.writeStream.format("kafka").options(**options)
        .option("checkpointLocation", checkpoint).start()
    )
