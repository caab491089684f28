from __future__ import annotations

import itertools
import os
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.trees import Lake  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("grovelift-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def clock():
    """A clock that moves one second with each look."""
    ticks = itertools.count()
    return lambda: datetime(2026, 1, 1) + timedelta(seconds=next(ticks))


_numbers = itertools.count(1)


@pytest.fixture
def lake(spark):
    """An empty database with state tables, and helpers to put trees into it."""
    return Lake(spark, f"lake_{next(_numbers)}")


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / os.environ.get("GROVELIFT_TEST_SF", "sf0.001")
    if not path.exists():
        pytest.skip("sample tables are not here")
    return str(path)
