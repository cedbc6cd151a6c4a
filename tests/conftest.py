"""One local session for all tests, and rows to frames."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from termloom.runtime import show_package

    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    show_package(made)
    yield made
    made.stop()


@pytest.fixture
def docs(spark):
    """(doc_id, text) rows to a frame over a few partitions."""

    def make(rows, schema: str = "doc_id long, text string", parts: int = 3):
        return spark.createDataFrame(list(rows), schema).repartition(parts)

    return make
