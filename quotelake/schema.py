"""Message, warehouse and source schemas."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
PERCENT = T.DecimalType(5, 2)

# Column limits of the warehouse tables.
SYMBOL_LENGTH = 20
COMPANY_LENGTH = 255
SECTOR_LENGTH = 100

# Fixed value: sector of a quote that names none.
UNKNOWN_SECTOR = "Unknown"


# Fields of a quote message, in order. Volume is read as text here so that
# 1000.0 and values over 2^31 survive.
MESSAGE = {
    "symbol": T.StringType(),
    "price": T.DoubleType(),
    "volume": T.StringType(),
    "change": T.DoubleType(),
    "change_percent": T.DoubleType(),
    "day_high": T.DoubleType(),
    "day_low": T.DoubleType(),
    "event_time": T.StringType(),
    "company_name": T.StringType(),
    "sector": T.StringType(),
}
MESSAGE_FIELDS = list(MESSAGE)


def message_schema(volume: T.DataType | None = None) -> T.StructType:
    """Schema of a quote message; ``IntegerType()`` nulls volumes as a 32-bit field would."""
    types = MESSAGE | {"volume": volume or MESSAGE["volume"]}
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# What a Kafka source yields; the file twin stores the same columns.
TOPIC = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
SOURCE_COORDINATES = ("topic", "partition", "offset")

# Partition of messages whose source numbers no rows; their offset is a hash.
NO_PARTITION = -1

# Columns of the fact table, in order.
FACT_MEASURES = ("price", "volume", "day_high", "day_low", "change", "change_percent")
FACT_COLUMNS = ("symbol", *FACT_MEASURES, "event_time", "processing_time", "load_time")

# The folders of a micro-batch add these two.
BATCH_KEYS = [
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]

FACT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", MONEY),
    T.StructField("volume", T.LongType()),
    T.StructField("day_high", MONEY),
    T.StructField("day_low", MONEY),
    T.StructField("change", MONEY),
    T.StructField("change_percent", PERCENT),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("processing_time", T.TimestampType()),
    T.StructField("load_time", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("event_date", T.DateType()),
])

DIM = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("last_event_time", T.TimestampType()),
    T.StructField("last_offset", T.LongType()),
])

FIRST_SEEN = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("offset", T.LongType()),
])

DAILY_PARTIAL = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("num_transactions", T.LongType()),
    T.StructField("sum_price", T.DecimalType(38, 2)),
    T.StructField("max_price", MONEY),
    T.StructField("min_price", MONEY),
    T.StructField("total_volume", T.DecimalType(38, 0)),
    T.StructField("highest_day_high", MONEY),
    T.StructField("lowest_day_low", MONEY),
    T.StructField("load_time", T.TimestampType()),
])

DAILY = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("num_transactions", T.LongType()),
    T.StructField("avg_price", T.DoubleType()),
    T.StructField("max_price", MONEY),
    T.StructField("min_price", MONEY),
    T.StructField("total_volume", T.DecimalType(38, 0)),
    T.StructField("highest_day_high", MONEY),
    T.StructField("lowest_day_low", MONEY),
    T.StructField("load_time", T.TimestampType()),
])

QUARANTINE = T.StructType([
    T.StructField("reject_reason", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("processing_time", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

BATCH_METRICS = T.StructType([
    T.StructField("started_at", T.TimestampType()),
    T.StructField("num_input_rows", T.LongType()),
    T.StructField("batch_ms", T.LongType()),
    T.StructField("figures", T.MapType(T.StringType(), T.LongType())),
])

DELETES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("deleted_at", T.TimestampType()),
])

THROUGHPUT = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("records", T.LongType()),
    T.StructField("first_offset", T.LongType()),
    T.StructField("last_offset", T.LongType()),
])
