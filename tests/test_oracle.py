"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_points
import oracle
from conftest import SF

QUERIES = {name: build for name, build in entry_points.queries().items()
           if build.__module__.startswith("quotelake.plans")}


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(SF)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    difference = oracle.compare(QUERIES[name](spark, SF), duck, entry_points.oracle_sql()[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", ["daily_summary", "stream_star_schema", "stream_throughput"])
def test_tables_may_be_folders_of_files(spark, duck, tmp_path, name):
    for table in ("events", "customer"):
        spark.read.parquet(f"{SF}/{table}.parquet").repartition(5).write.parquet(
            f"{tmp_path}/{table}.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    assert oracle.compare(df, duck, entry_points.oracle_sql()[name]) is None
