"""Warehouse tables in a database over JDBC. Needs the database's driver on the classpath."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quotelake.schema import FACT_COLUMNS

# Rows per insert batch and driver of the warehouse.
BATCH_ROWS = 1000
DRIVER = "org.postgresql.Driver"


@dataclass(frozen=True)
class Database:
    """Where to connect; credentials come from the caller and have no default."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = DRIVER
    properties: dict[str, str] = field(default_factory=lambda: {
        "stringtype": "unspecified", "reWriteBatchedInserts": "true"})

    def connection(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password,
                "driver": self.driver, **self.properties}


def postgres(host: str, database: str, user: str, password: str, port: int = 5432) -> Database:
    return Database(f"jdbc:postgresql://{host}:{port}/{database}", user, password)


def write_options(db: Database, table: str, connections: int,
                  batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    """``connections`` bounds the writers: Spark narrows wider frames to that many, so it is
    for the caller to say what the database bears."""
    return {**db.connection(), "dbtable": table, "batchsize": str(batch_rows),
            "numPartitions": str(connections)}


def read_options(db: Database, table: str, column: str | None = None, lower: str | None = None,
                 upper: str | None = None, connections: int = 1,
                 fetch_rows: int = 10_000) -> dict[str, str]:
    """With a numeric, date or time ``column`` the scan is split into parallel ranges."""
    options = {**db.connection(), "dbtable": table, "fetchsize": str(fetch_rows)}
    if column is not None:
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(connections)}
    return options


def append(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()


def replace(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def scan(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


# Columns of the dimension in the database; created_at of a known symbol stays.
DIM_COLUMNS = ("symbol", "company_name", "sector", "created_at", "updated_at")


def staging_rows(dim_changes: DataFrame) -> DataFrame:
    """What a batch's dimension changes put into the staging table."""
    return dim_changes.select(*DIM_COLUMNS)


def merge_statement(table: str = "dim_stock", staging: str = "dim_stock_staging") -> str:
    """Insert new symbols from the staging table and update known ones by later changes."""
    columns = ", ".join(DIM_COLUMNS)
    changed = ", ".join(f"{c} = excluded.{c}" for c in DIM_COLUMNS[1:] if c != "created_at")
    return (f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
            f"ON CONFLICT (symbol) DO UPDATE SET {changed} "
            f"WHERE {table}.updated_at <= excluded.updated_at")


def stage_symbols(dim_changes: DataFrame, db: Database, connections: int,
                  staging: str = "dim_stock_staging") -> None:
    """Replace the staging table's rows by a batch's changes. The caller's database client
    then runs ``merge_statement``; it reads nothing of the dimension back."""
    replace(staging_rows(dim_changes), write_options(db, staging, connections) | {"truncate": "true"})


def append_facts(facts: DataFrame, db: Database, connections: int,
                 table: str = "fact_stock_prices", **tuning: int) -> None:
    """Insert facts; the database numbers the rows."""
    append(facts.select(*FACT_COLUMNS), write_options(db, table, connections, **tuning))


def star_sink(db: Database, connections: int, run_statement: Callable[[str], None], **tuning: int):
    """Hook for the star-schema job that also brings each batch to the database, symbols
    before facts. ``run_statement`` executes a statement there. Facts of a batch that is
    repeated are appended again."""
    def write(changes: DataFrame, facts: DataFrame) -> None:
        stage_symbols(changes, db, connections)
        run_statement(merge_statement())
        append_facts(facts, db, connections, **tuning)
    return write
