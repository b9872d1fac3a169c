"""Quote frames over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotelake.schema import MONEY, PERCENT


# The fields a quote needs beyond value come from k, the number in ``props`` (0..99).


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_number() -> Column:
    return F.regexp_extract("props", r'"k": *(\d+)', 1).cast("bigint")


def _at() -> Column:
    """Event time without zone; no cast is left when the table stores it so."""
    return F.col("ts").cast("timestamp_ntz")


def _symbol(column: str) -> Column:
    return F.concat(F.lit("S"), F.col(column).cast("string"))


def quotes(events: DataFrame) -> DataFrame:
    """events -> facts: symbol per user, price from value, the rest from k."""
    price, k = F.col("price"), F.col("volume").cast("decimal(4,0)")
    return events.select(
        F.col("event_id").alias("id"),
        _symbol("user_id").alias("symbol"),
        F.col("value").cast(MONEY).alias("price"),
        k_number().alias("volume"),
        _at().alias("event_time"),
    ).select(
        "id", "symbol", "price", "volume",
        (price + k).cast(MONEY).alias("day_high"),
        (price - k).cast(MONEY).alias("day_low"),
        (k - 50).cast(MONEY).alias("change"),
        ((k - 50) * F.lit("0.1").cast("decimal(2,1)")).cast(PERCENT).alias("change_percent"),
        "event_time",
    )


def named_quotes(events: DataFrame) -> DataFrame:
    """Symbol, company and sector as each event states them; they change over time."""
    return events.select(
        F.col("event_id").alias("id"),
        _symbol("user_id").alias("symbol"),
        F.concat(_symbol("user_id"), F.lit(" "), F.col("event_type")).alias("company_name"),
        F.col("event_type").alias("sector"),
        _at().alias("event_time"),
    )


def dim(customers: DataFrame) -> DataFrame:
    """customer -> dimension."""
    return customers.select(
        _symbol("c_custkey").alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
    )


def supplier_dim(suppliers: DataFrame) -> DataFrame:
    """supplier -> dimension with the nation as sector."""
    return suppliers.select(
        _symbol("s_suppkey").alias("symbol"),
        F.col("s_name").alias("company_name"),
        F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("sector"),
    )


def part_quotes(lineitem: DataFrame) -> DataFrame:
    """lineitem -> facts with one symbol per part, for runs on more rows."""
    return lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.lit(None).cast(MONEY).alias("day_high"),
        F.lit(None).cast(MONEY).alias("day_low"),
        F.col("l_discount").cast(PERCENT).alias("change_percent"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("event_time"),
    )


def part_dim(part: DataFrame) -> DataFrame:
    """part -> dimension with the brand as sector."""
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_name").alias("company_name"),
        F.col("p_brand").alias("sector"),
    )


def latencies(events: DataFrame) -> DataFrame:
    """events with a processing time of k * 37 ms after the event."""
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_add("MILLISECOND", k_number() * 37, start)
    return events.select(
        F.col("event_id").alias("id"), "user_id", "event_type",
        start.alias("event_time"), end.alias("processing_time"))


# k -> fault of the message derived from an event with that k.
FAULTS = {
    0: "truncated", 1: "symbol_null", 2: "price_null", 3: "volume_null", 4: "price_overflow",
    5: "volume_64_bit", 6: "names_null", 7: "event_time_null", 8: "event_time_bogus",
    9: "percent_overflow", 10: "symbol_long", 11: "symbol_empty", 12: "volume_decimal",
    13: "company_long", 14: "sector_long", 15: "short_time_fields",
}


def messages(events: DataFrame, partition: Column | None = None) -> DataFrame:
    """events -> topic rows: a JSON quote each, faulty where k is in ``FAULTS``. All are of
    partition 0 unless ``partition`` says otherwise."""
    code = {name: k for k, name in FAULTS.items()}
    k = F.col("k")

    def unless(fault: str, value: Column, instead: Column) -> Column:
        return F.when(k == code[fault], instead).otherwise(value)

    def null_if(fault: str, value: Column) -> Column:
        return F.when(k != code[fault], value)

    base = events.select(
        "event_id", "user_id", "event_type", "value", k_number().alias("k"),
        F.col("ts").cast("timestamp").alias("at"), _symbol("user_id").alias("plain"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"))
    symbol = unless("symbol_long", unless("symbol_empty", F.col("plain"), F.lit("")),
                    F.rpad(F.col("plain"), 21, "X"))
    symbol = null_if("symbol_null", symbol)
    price = null_if("price_null", unless("price_overflow", F.col("value"), F.lit(1e9)))
    volume = F.when(k == code["volume_64_bit"], F.lit("3000000000")).when(
        k == code["volume_decimal"], F.lit("1000.0")).when(
        k != code["volume_null"], k.cast("string"))
    stamp = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = F.when(k == code["event_time_bogus"], F.lit("bogus")).when(
        k == code["short_time_fields"], F.date_format("at", "yyyy-M-d'T'H:m:s")).when(
        k != code["event_time_null"], stamp)
    company = unless("company_long", F.concat(F.lit("Company "), F.col("plain")),
                     F.rpad(F.col("plain"), 256, "X"))
    sector = unless("sector_long", F.col("event_type"), F.rpad(F.col("plain"), 101, "X"))
    # Volume is spliced in as text so that the message carries 1000.0 as such.
    body = F.to_json(F.struct(
        symbol.alias("symbol"), price.alias("price"),
        (k - 50).cast("double").alias("change"),
        unless("percent_overflow", (k - 50) / F.lit(10.0), F.lit(1234.5)).alias("change_percent"),
        (F.col("value") + k).alias("day_high"), (F.col("value") - k).alias("day_low"),
        stamp.alias("event_time"),
        null_if("names_null", company).alias("company_name"),
        null_if("names_null", sector).alias("sector"),
    ))
    body = F.concat(F.lit('{"volume":'), F.coalesce(volume, F.lit("null")), F.lit(","),
                    F.substr(body, F.lit(2)))
    body = unless("truncated", body, F.substring(body, 1, 30))
    return base.select(
        F.col("plain").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("quotes").alias("topic"),
        "partition",
        F.col("event_id").alias("offset"),
        F.col("at").alias("timestamp"),
    )


def vendor_payloads(events: DataFrame) -> DataFrame:
    """events -> vendor payload texts; some lack fields, the root, or valid content."""
    k = F.col("k")
    base = events.select(k_number().alias("k"), "value", "event_id",
                         _symbol("user_id").alias("symbol"),
                         F.col("ts").cast("timestamp").alias("fetched_at"))
    fields = F.map_from_arrays(
        F.array(F.lit("05. price"), F.lit("06. volume"), F.lit("09. change"),
                F.lit("10. change percent")),
        F.array(F.col("value").cast("string"), k.cast("string"), (k - 50).cast("string"),
                F.concat(((k - 50) / F.lit(10.0)).cast("string"), F.lit("%"))))
    fields = F.when(k == 0, F.map_filter(fields, lambda n, _: n != "06. volume")).when(
        k == 1, F.map_filter(fields, lambda n, _: n != "10. change percent")).otherwise(fields)
    payload = F.to_json(F.struct(fields.alias("Global Quote")))
    payload = (
        F.when(k == 2, F.lit("{}"))
        .when(k == 3, F.lit('{"Note": "call limit reached"}'))
        .when(k == 4, F.lit("not json"))
        .when(k == 5, F.replace(payload, F.lit('"05. price":"'), F.lit('"05. price":"n/a')))
        .otherwise(payload)
    )
    return base.select("event_id", "symbol", payload.alias("payload"), "fetched_at")


# Deliveries in which the stream queries get their rows.
ARRIVALS = 4


def arrivals(rows: DataFrame, time: str, number: str, late: bool = True) -> DataFrame:
    """Rows with ``arrival``, the delivery that brings them: the quarters of the time they span,
    in order. With ``late``, of ten rows one comes two deliveries after its quarter's."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    span = rows.agg(F.min(micros).alias("first"), F.max(micros).alias("last"))
    placed = rows.withColumns({"__at": micros, "__first": span.select("first").scalar(), "__last": span.select("last").scalar()})
    quarter = F.expr(f"{ARRIVALS} * (__at - __first) div (__last - __first + 1)")
    delay = F.when(F.col(number) % 10 == 3, 2).otherwise(0) if late else F.lit(0)
    return placed.withColumn("arrival", F.least(F.lit(ARRIVALS - 1), (quarter + delay).cast("int"))).drop(
        "__at", "__first", "__last")
