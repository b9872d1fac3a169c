import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from pyspark.sql import SparkSession  # noqa: E402

from quotelake import configure  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("quotelake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
