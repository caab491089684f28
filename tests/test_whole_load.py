"""`run_table` and `run_all` on the sample tables, against the SQL of the sample queries."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from grovelift import run_all, run_table
from grovelift.plans.config import upsert_config
from grovelift.plans.load import _Load
from grovelift.plans.oracles import ORACLES
from grovelift.plans.sample_queries import CHAIN_TABLE, RUN_ID, TABLE
from grovelift.sources.bindings import chain, forest
from grovelift.sources.files import TargetTable
from tests.test_queries import TABLES, normal


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return lambda name: connection.execute(ORACLES[name]).df()


@pytest.fixture
def store(spark, lake, sf_dir):
    """Put the order forest or the conversation chain into a configured table."""

    def put(name, bind):
        inputs, short = bind(spark, sf_dir), bind.__name__
        for role, rows in (("src", inputs.source), ("meta", inputs.metadata)):
            lake.put(f"{short}_{role}", rows)
        lake.put(f"{short}_allowed", inputs.allowed)
        row = lake.config_rows(short).withColumns(
            {"table_name": F.lit(name), "metadata_id_column": F.lit(inputs.id_column)}
        )
        upsert_config(lake.state, row)
        target = TargetTable(spark, lake.name(f"{short}_tgt")).create()
        target.load_initial(inputs.target)
        return target, lake.name(f"{short}_allowed"), inputs.excluded_id

    return put


def held(target: TargetTable) -> pd.DataFrame:
    return normal(target.rows().withColumn("file_stream", F.hex("file_stream")).toPandas())


def logged(rows: pd.DataFrame) -> list[tuple]:
    rows = rows[rows.status != "Failed"]
    columns = ["step", "batch_number", "rows_inserted", "total_rows_inserted", "status"]
    return sorted(rows[columns].itertuples(index=False, name=None))


def test_forest(lake, store, duck, clock):
    target, allowed, excluded = store(TABLE, forest)
    options = {"excluded_id": excluded, "run_id": RUN_ID, "clock": clock}
    run_table(lake.state, TABLE, allowed, **options)
    expected = normal(duck("migrated_target"))
    pd.testing.assert_frame_equal(held(target), expected)
    log = logged(duck("progress_log"))
    assert logged(lake.state.progress(RUN_ID, TABLE).toPandas()) == log
    queue = lake.state.queue(RUN_ID, TABLE).toPandas()
    assert sorted(queue.stream_id) == sorted(duck("parent_queue").stream_id)
    assert queue.processed.all()

    run_table(lake.state, TABLE, allowed, reset=True, **options)  # rows stay, state starts anew
    pd.testing.assert_frame_equal(held(target), expected)
    assert lake.state.queue(RUN_ID, TABLE).isEmpty()
    assert {r[2] for r in logged(lake.state.progress(RUN_ID, TABLE).toPandas())} == {0}


def test_forest_after_a_crash(lake, store, duck, clock, monkeypatch):
    target, allowed, excluded = store(TABLE, forest)
    options = {"excluded_id": excluded, "run_id": RUN_ID, "clock": clock, "chunk_rows": 500}
    write, calls = _Load._commit, []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(self, *args)

    monkeypatch.setattr(_Load, "_commit", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run_table(lake.state, TABLE, allowed, **options)
    run_table(lake.state, TABLE, allowed, **options)
    pd.testing.assert_frame_equal(held(target), normal(duck("migrated_target")))
    assert logged(lake.state.progress(RUN_ID, TABLE).toPandas()) == logged(duck("progress_log"))


def test_two_tables(lake, store, duck, clock):
    first, allowed, excluded = store(TABLE, forest)
    second, owners, _ = store(CHAIN_TABLE, chain)
    options = {"run_id": RUN_ID, "excluded_id": excluded, "clock": clock}
    run_all(lake.state, [TABLE], allowed, **options)
    run_all(lake.state, [CHAIN_TABLE], owners, **options)
    expected = duck("migrated_two_tables")
    for name, target in ((TABLE, first), (CHAIN_TABLE, second)):
        own = expected[expected.table_name == name].drop(columns="table_name")
        pd.testing.assert_frame_equal(held(target), normal(own))
