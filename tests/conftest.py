from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from parley.session import build_session

SF = "/root/testdata/sf0.001"


def build() -> SparkSession:
    spark = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = build()
    yield session
    session.stop()
