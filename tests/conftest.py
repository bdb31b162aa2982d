from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from portdelta.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "portdelta-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def golden(spark):
    """One key, eleven one-minute samples 13:50 to 14:00."""
    from pyspark.sql import functions as F

    values = [5196985, 5197052, 5197118, 5197184, 5197250, 5197316, 5197382, 5197448, 5197514, 5197646, 5197712]
    minutes = [f"10-03-2023 {13 + (50 + i) // 60}:{(50 + i) % 60:02d}" for i in range(11)]
    rows = [("d", "et-1/23", m, v) for m, v in zip(minutes, values)]
    df = spark.createDataFrame(rows, "devicename string, interface string, text string, in_octets long")
    return df.withColumn("ts", F.to_timestamp("text", "MM-dd-yyyy HH:mm")).drop("text")
