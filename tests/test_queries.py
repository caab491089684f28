"""Each sample query against SQL in another engine."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from grovelift.plans.sample_queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings"
TABLES += " pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    for column in frame.columns:
        values = [v for v in frame[column] if v is not None]
        if values and isinstance(values[0], pd.Timestamp):
            frame[column] = pd.to_datetime(frame[column]).astype("datetime64[us]").astype(str)
        elif values and not isinstance(values[0], (str, bool)):
            frame[column] = [None if v is None else int(v) for v in frame[column]]
    rows = sorted(frame.itertuples(index=False, name=None), key=repr)
    return pd.DataFrame(rows, columns=frame.columns, dtype=object)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = driver.queries()[name](spark, sf_dir).toPandas()
    expected = duck.execute(driver.oracle_sql()[name]).df()
    assert len(got) == len(expected)
    # Fewer parents than a batch holds leave nothing unprocessed.
    assert len(expected) > 0 or name == "queue_unprocessed"
    pd.testing.assert_frame_equal(normal(got), normal(expected))


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.count() > 0
