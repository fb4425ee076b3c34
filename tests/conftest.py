import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusmill.session import prepare_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare_session(session)
    session.stop()


@pytest.fixture
def small_splits(spark):
    """Input splits of a few dozen bytes."""
    names = {
        "spark.sql.files.maxPartitionBytes": "37",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "50",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    yield spark
    for name in names:
        spark.conf.unset(name)
