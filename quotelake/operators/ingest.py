"""Messages in and out: parse, normalise vendor payloads, filter symbols, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quotelake.functions import strip_percent
from quotelake.schema import (
    MESSAGE_FIELDS, SOURCE_COORDINATES, UNKNOWN_SECTOR, message_schema,
)

# Field names of the vendor payload and their defaults when absent.
VENDOR_ROOT = "Global Quote"
VENDOR_FIELDS = {
    "price": ("05. price", "0"),
    "volume": ("06. volume", "0"),
    "change": ("09. change", "0"),
    "change_percent": ("10. change percent", "0%"),
}


def parse_quotes(messages: DataFrame, volume: T.DataType | None = None,
                 keep_raw: bool = False) -> DataFrame:
    """Expand the JSON in ``value`` to the message fields.

    Malformed JSON gives a row of nulls. Source columns that are present (topic,
    partition, offset, timestamp) pass through, the last as ``broker_time``;
    ``keep_raw`` adds the text itself. The fields come out of a generator, so a
    filter on them is not pushed below the parse and each message is parsed once.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, message_schema(volume))
    kept: list[Column] = [F.col(c) for c in SOURCE_COORDINATES if c in messages.columns]
    if "timestamp" in messages.columns:
        kept.append(F.col("timestamp").alias("broker_time"))
    if keep_raw:
        kept.append(text.alias("raw_value"))
    return messages.select(*kept, F.inline(F.array(parsed)))


def flag_vendor(payloads: DataFrame) -> DataFrame:
    """Vendor payload text -> message fields, the payload and a reject reason.

    Input columns: symbol, payload (JSON text), fetched_at. An absent field takes its
    default, a payload without the root object is all defaults. A payload that is not
    JSON is ``payload_malformed``, a field that is present but not a number ``<field>_bad``.
    """
    schema = T.StructType([
        T.StructField(VENDOR_ROOT, T.MapType(T.StringType(), T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ])
    document = F.from_json("payload", schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    opened = payloads.select(
        F.trim("symbol").alias("symbol"), "payload", "fetched_at", F.inline(F.array(document)))

    fields = F.col(f"`{VENDOR_ROOT}`")

    def lookup(name: str) -> Column:
        key, default = VENDOR_FIELDS[name]
        absent = fields.isNull() | ~F.map_contains_key(fields, key)
        return F.when(absent, F.lit(default)).otherwise(F.try_element_at(fields, F.lit(key)))

    typed = opened.select(
        "symbol",
        lookup("price").try_cast("double").alias("price"),
        lookup("volume").try_cast("bigint").alias("volume"),
        lookup("change").try_cast("double").alias("change"),
        strip_percent(lookup("change_percent")).try_cast("double").alias("change_percent"),
        F.lit(0.0).alias("day_high"),
        F.lit(0.0).alias("day_low"),
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        F.col("symbol").alias("company_name"),
        F.lit(UNKNOWN_SECTOR).alias("sector"),
        "payload", "_corrupt_record",
    )
    reason = F.when(F.col("_corrupt_record").isNotNull(), "payload_malformed")
    for name in VENDOR_FIELDS:
        reason = reason.when(F.col(name).isNull(), f"{name}_bad")
    return typed.withColumn("reject_reason", reason).drop("_corrupt_record")


def normalize_vendor(payloads: DataFrame) -> DataFrame:
    """The message fields of the payloads that are in order."""
    return flag_vendor(payloads).filter(F.col("reject_reason").isNull()).drop("payload", "reject_reason")


def quarantine_vendor(payloads: DataFrame) -> DataFrame:
    """symbol, payload and reject_reason of the others."""
    bad = flag_vendor(payloads).filter(F.col("reject_reason").isNotNull())
    return bad.select("symbol", "payload", "reject_reason")


def symbol_list(symbols_csv: str) -> list[str]:
    """'A, B ,C' -> ['A', 'B', 'C']."""
    return [s.strip() for s in symbols_csv.split(",") if s.strip()]


def symbol_filter(df: DataFrame, symbols_csv: str, column: str = "symbol") -> DataFrame:
    """Rows whose symbol is in the comma-separated list; pushed down as an IN filter."""
    return df.filter(F.col(column).isin(symbol_list(symbols_csv)))


def explode_symbols(df: DataFrame, column: str) -> DataFrame:
    """One row per trimmed symbol of a comma-separated column."""
    parts = F.transform(F.split(F.col(column), ","), lambda s: F.trim(s))
    return df.select("*", F.explode(parts).alias("symbol")).filter(F.col("symbol") != "")


def publish_frame(quotes: DataFrame) -> DataFrame:
    """Keyed messages: key = symbol, value = JSON of the ten message fields."""
    body = F.struct(*[F.col(c) for c in MESSAGE_FIELDS])
    return quotes.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )
