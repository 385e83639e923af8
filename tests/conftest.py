import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


START = datetime(2024, 1, 1)


def log_rows(spark, outcomes, table_name="dim_account", subtask="1/4", error="java.lang.RuntimeException", message="down"):
    """A lookup log from (milliseconds, keys, failed over) per batch."""
    from tandem.plans.log import LOG_SCHEMA

    rows = [
        (
            table_name, subtask, i, START + timedelta(milliseconds=ms), keys, "hbase", "doris", 10.0,
            error if failed else None, message if failed else None, None if failed else keys, failed,
            5.0 if failed else None, None, keys if failed else None, "doris" if failed else "hbase", 10,
        )
        for i, (ms, keys, failed) in enumerate(outcomes)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)
