import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from paysieve.config import spark_conf  # noqa: E402
from paysieve.sources import remove_scratch  # noqa: E402

EVENTS_DIR = "/root/testdata/sf0.001"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("paysieve-tests")
        .config(map=spark_conf())
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def payments(spark):
    from paysieve.queries import payments as derive

    return derive(spark, EVENTS_DIR)


def at(seconds):
    """A moment that many seconds after the epoch; None stays None."""
    return None if seconds is None else EPOCH + timedelta(seconds=seconds)


def same_rows(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
