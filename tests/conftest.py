from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


def make_session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidepanel-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Treat any key with more than a few rows as hot."""
    from tidepanel.operators.skew import HOT_ROWS_KEY

    def limit(rows: int) -> None:
        spark.conf.set(HOT_ROWS_KEY, str(rows))

    yield limit
    spark.conf.unset(HOT_ROWS_KEY)
