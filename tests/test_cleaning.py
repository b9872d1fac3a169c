import json
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from quotelake.operators import cleaning
from quotelake.operators.ingest import parse_quotes
from quotelake.schema import FACT_COLUMNS, FACT, TOPIC

BROKER_TIME = datetime(2024, 5, 6, 7, 8, 9, 500000)


def topic(spark, texts):
    rows = [(b"k", t if t is None else t.encode(), "quotes", 0, i, BROKER_TIME)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, TOPIC)


def flagged(spark, *texts, volume=None, **options):
    parsed = parse_quotes(topic(spark, texts), volume, keep_raw=True)
    return cleaning.flag_quotes(parsed, **options).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")).orderBy("offset").collect()


def test_hand_written_rows(spark):
    rows = flagged(
        spark,
        '{"symbol":"A","price":10.005,"volume":5,"event_time":"2024-01-02T03:04:05.123456"}',
        '{"symbol":"B","price":1.0,"volume":3000000000,"event_time":"2024-01-02T03:04:05"}',
        '{"symbol":"C","price":2.675,"volume":1000.0,"event_time":null}',
        '{"symbol":"D","price":"12.5","event_time":"bogus"}',
        '{"symbol":"D2","price":12.5,"event_time":"bogus"}',
        "{bad json", "null",
        '{"symbol":"","price":0.0}',
        '{"symbol":"E","price":123456789.0}',
        '{"symbol":"F","price":1.0,"change_percent":1234.5}',
        '{"symbol":"G","price":1.0,"extra":1}',
        None,
    )
    a, b, c, d, d2, bad, null, empty, e, f, g, none = rows
    assert (a.price, a.event_time) == (Decimal("10.01"), datetime(2024, 1, 2, 3, 4, 5))
    assert b.volume == 3_000_000_000
    assert (c.price, c.volume) == (Decimal("2.68"), 1000)
    assert c.event_time == BROKER_TIME.replace(microsecond=0)
    assert [r.reject_reason for r in rows] == [
        None, None, None, "price_null", "event_time_bad", "symbol_null", "symbol_null",
        "symbol_empty", "price_null", None, None, "symbol_null"]
    assert f.change_percent is None
    assert (g.company_name, g.sector, g.volume) == ("G", "Unknown", 0)
    assert bad.raw_value == "{bad json" and a.raw_value is None
    assert a.processing_time == a.load_time


def test_32_bit_volume_falls_to_zero(spark):
    (row,) = flagged(spark, '{"symbol":"B","price":1,"volume":3000000000}', volume=T.IntegerType())
    assert row.volume == 0 and row.reject_reason is None


def test_length_rules(spark):
    rows = flagged(
        spark,
        json.dumps({"symbol": "x" * 20, "price": 1}), json.dumps({"symbol": "x" * 21, "price": 1}),
        json.dumps({"symbol": "A", "price": 1, "company_name": "c" * 256}),
        json.dumps({"symbol": "A", "price": 1, "sector": "s" * 101}))
    assert [r.reject_reason for r in rows] == [None, "symbol_long", "company_long", "sector_long"]


def test_minimal_rules_keep_empty_symbol_and_bad_time(spark):
    rows = flagged(
        spark, '{"symbol":"","price":0.0}', '{"symbol":"A","price":1,"event_time":"x"}', "null",
        rules=cleaning.MINIMAL_RULES)
    assert [r.reject_reason for r in rows] == [None, None, "symbol_null"]


def test_default_event_time_and_fraction(spark):
    given_time = F.lit(datetime(2020, 1, 1, 0, 0, 0, 250000))
    (row,) = flagged(spark, '{"symbol":"A","price":1}', default_event_time=given_time)
    assert row.event_time == datetime(2020, 1, 1)
    (row,) = flagged(spark, '{"symbol":"A","price":1}', keep_fraction=True)
    assert row.event_time == BROKER_TIME


def test_types_match_the_fact_table(spark):
    clean = cleaning.clean_quotes(parse_quotes(topic(spark, [])))
    for name in FACT_COLUMNS:
        assert clean.schema[name].dataType == FACT[name].dataType, name


quote = st.fixed_dictionaries({}, optional={
    "symbol": st.one_of(st.none(), st.text(max_size=25)),
    "price": st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False), st.text(max_size=3)),
    "volume": st.one_of(st.none(), st.integers(), st.floats(allow_nan=False, allow_infinity=False)),
    "change_percent": st.one_of(st.none(), st.floats(-2000, 2000)),
    "event_time": st.one_of(st.none(), st.datetimes().map(lambda d: d.isoformat()), st.text(max_size=8)),
    "sector": st.one_of(st.none(), st.text(max_size=5)),
})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(quote.map(json.dumps), st.text(max_size=12)), max_size=30))
def test_clean_and_quarantine_partition_the_input(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    parsed = parse_quotes(topic(spark, texts), keep_raw=True)
    clean = {r.offset for r in cleaning.clean_quotes(parsed).select("offset").collect()}
    bad = {r.offset for r in cleaning.quarantine_quotes(parsed).select("offset").collect()}
    assert not clean & bad and clean | bad == set(range(len(texts)))
