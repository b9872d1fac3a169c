import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from plan import physical
from quotelake.operators import ingest
from quotelake.schema import MESSAGE_FIELDS


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").withColumn(
        "value", F.col("value").cast("binary"))


def test_parse_fields_and_extra_field(spark):
    row = ingest.parse_quotes(messages(spark, '{"symbol":"G","price":1.5,"volume":7,"extra":1}')).first()
    assert (row.symbol, row.price, row.volume, row.sector) == ("G", 1.5, "7", None)


@pytest.mark.parametrize("text", ["{bad json", "null", "", '{"symbol":"A","pri', "[1]"])
def test_malformed_gives_nulls(spark, text):
    rows = ingest.parse_quotes(messages(spark, text)).collect()
    assert len(rows) == 1 and all(v is None for v in rows[0])


def test_text_price_is_null(spark):
    assert ingest.parse_quotes(messages(spark, '{"symbol":"D","price":"12.5"}')).first().price is None


@pytest.mark.parametrize("raw, expected", [("3000000000", None), ("1000.0", None), ("12", 12)])
def test_volume_as_32_bit(spark, raw, expected):
    parsed = ingest.parse_quotes(
        messages(spark, f'{{"symbol":"B","price":1,"volume":{raw}}}'), T.IntegerType()).first()
    assert (parsed.symbol, parsed.volume) == ("B", expected)


def test_each_message_is_parsed_once(spark):
    parsed = ingest.parse_quotes(messages(spark, "{}")).filter("symbol is not null and price > 1")
    assert physical(parsed).count("from_json(") == 1


def payloads(spark, *rows):
    return spark.createDataFrame(rows, "symbol string, payload string").withColumn(
        "fetched_at", F.lit(datetime(2024, 1, 2, 3, 4, 5)))


def test_vendor_payload(spark):
    body = {"Global Quote": {"05. price": "150.25", "06. volume": "1000000",
                             "09. change": "1.50", "10. change percent": "-1.01%"}}
    row = ingest.normalize_vendor(payloads(spark, (" AAPL ", json.dumps(body)))).first()
    assert row.asDict() == {
        "symbol": "AAPL", "price": 150.25, "volume": 1000000, "change": 1.5,
        "change_percent": -1.01, "day_high": 0.0, "day_low": 0.0,
        "event_time": "2024-01-02T03:04:05.000000", "company_name": "AAPL", "sector": "Unknown"}


@pytest.mark.parametrize("body", ["{}", '{"Note": "limit"}', '{"Global Quote": {}}'])
def test_vendor_payload_without_fields_is_zero(spark, body):
    row = ingest.normalize_vendor(payloads(spark, ("A", body))).first()
    assert (row.price, row.volume, row.change, row.change_percent) == (0.0, 0, 0.0, 0.0)


@pytest.mark.parametrize("body", [
    "not json", '{"Global Quote": {"05. price": "n/a"}}', '{"Global Quote": {"06. volume": "1.5"}}',
    '{"Global Quote": {"05. price": null}}',
])
def test_vendor_payload_with_bad_content_is_dropped(spark, body):
    assert ingest.normalize_vendor(payloads(spark, ("A", body))).count() == 0


def test_symbol_lists(spark):
    assert ingest.symbol_list(" A, B ,,C") == ["A", "B", "C"]
    df = spark.createDataFrame([("A",), ("B",), ("X",)], "symbol string")
    assert {r.symbol for r in ingest.symbol_filter(df, "A, X").collect()} == {"A", "X"}
    lists = spark.createDataFrame([("A, B",), (" C ,",)], "watch string")
    assert [r.symbol for r in ingest.explode_symbols(lists, "watch").collect()] == ["A", "B", "C"]


def test_published_message_parses_to_itself(spark):
    quote = spark.createDataFrame(
        [("A", 10.25, "7", 0.5, 1.0, 0.0, 0.0, "2024-01-02T03:04:05", "A", None)],
        ingest.message_schema())
    published = ingest.publish_frame(quote)
    sent = json.loads(bytes(published.first().value))
    assert sent["sector"] is None and list(sent) == list(MESSAGE_FIELDS)
    assert bytes(published.first().key) == b"A"
    assert ingest.parse_quotes(published).collect() == quote.collect()
