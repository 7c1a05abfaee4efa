from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def lake(spark):
    """A new folder for tables."""
    from lakestar.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture()
def with_conf(spark):
    """Sets session options for one test."""
    before = {}

    def apply(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield apply
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
