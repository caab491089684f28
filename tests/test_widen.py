"""Moving stored state to a wider key."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from grovelift import schemas as S
from grovelift.operators.keys import key_violations
from grovelift.sources import widen as widen_module
from grovelift.sources.catalog import create_table
from grovelift.sources.state import StateStore

AT = datetime(2026, 1, 1)
RUNS = ("A1", "B2")


def log_rows(spark, rows):
    """Log rows (run, step, batch, rows inserted) as they were kept without a table name."""
    frame = spark.createDataFrame(rows, "run_id string, step short, batch_number int, rows_inserted long")
    at = F.lit(AT).cast("timestamp_ntz")
    return frame.select(
        at.alias("run_started_at"), "step", "batch_number", "rows_inserted",
        F.col("rows_inserted").alias("total_rows_inserted"),
        at.alias("batch_started_at"), at.alias("batch_completed_at"),
        F.lit("InProgress").alias("status"), F.lit(None).cast("string").alias("error_message"),
        "run_id",
    )


ROWS = [(run, step, batch, 10 * batch) for run in RUNS for step in (1, 2) for batch in (1, 2)]


def narrow_state(spark, lake, rows, location=None):
    """A store whose log has the key (run, step, batch)."""
    name = lake.state.name("progress")
    spark.sql(f"DROP TABLE {name}")
    held = log_rows(spark, rows)
    create_table(spark, name, held.schema, ["run_id"], location and f"{location}/progress")
    held.write.insertInto(name)
    return lake.state


def content(state, run, table="orders"):
    rows = state.progress(run, table).select("step", "batch_number", "rows_inserted").collect()
    return sorted(map(tuple, rows))


def check_moved(spark, state):
    for run in RUNS:
        assert content(state, run) == [(s, b, 10 * b) for s in (1, 2) for b in (1, 2)]
    stored = spark.table(state.name("progress"))
    assert stored.schema.names == S.PROGRESS_SCHEMA.names
    assert key_violations(stored, S.PROGRESS_KEY).isEmpty()


def test_rows_move_and_the_wider_key_holds_more(spark, lake):
    state = narrow_state(spark, lake, ROWS)
    assert state.widen("progress", {"table_name": "orders"})
    check_moved(spark, state)
    assert not state.widen("progress", {"table_name": "other"})
    # The same run, step and batch of another table, which the narrow key forbade.
    more = log_rows(spark, [("A1", 1, 1, 7)]).drop("run_id")
    more = more.withColumns({"failure_number": F.lit(0), "queue_taken": F.lit(0).cast("long")})
    state.write_progress("A1", "lines", 1, 1, more)
    assert content(state, "A1", "lines") == [(1, 1, 7)]
    check_moved(spark, state)


def test_values_may_differ_by_row(spark, lake):
    state = narrow_state(spark, lake, ROWS)
    name = F.when(F.col("run_id") == "A1", "orders").otherwise("lines")
    assert state.widen("progress", {"table_name": name})
    assert len(content(state, "A1")) == len(content(state, "B2", "lines")) == 4
    assert content(state, "B2") == []


def test_a_key_that_is_not_unique_leaves_the_table(spark, lake):
    state = narrow_state(spark, lake, [*ROWS, ROWS[0]])
    with pytest.raises(ValueError, match="key"):
        state.widen("progress", {"table_name": "orders"})
    assert spark.table(state.name("progress")).count() == len(ROWS) + 1


def test_a_missing_value_leaves_the_table(spark, lake):
    state = narrow_state(spark, lake, ROWS)
    with pytest.raises(ValueError, match="table_name"):
        state.widen("progress", {})
    assert spark.table(state.name("progress")).count() == len(ROWS)


def test_nothing_stored(spark, lake):
    assert not lake.state.widen("progress", {"table_name": "orders"})
    assert not lake.state.widen("work_queue", {"table_name": "orders"})


@pytest.mark.parametrize("located", [False, True])
@pytest.mark.parametrize("at, before", [(1, True), (1, False), (2, True), (2, False)])
def test_a_crash_halfway(spark, lake, tmp_path, monkeypatch, located, at, before):
    """The run dies just before or after one of the two renames; the next call ends the move."""
    location = str(tmp_path / "state") if located else None
    state = narrow_state(spark, lake, ROWS, location)
    real, calls = widen_module._rename, []

    def dying(files, old, new):
        calls.append(new)
        if len(calls) == at and before:
            raise KeyboardInterrupt
        real(files, old, new)
        if len(calls) == at:
            raise KeyboardInterrupt

    monkeypatch.setattr(widen_module, "_rename", dying)
    with pytest.raises(KeyboardInterrupt):
        state.widen("progress", {"table_name": "orders"}, location)
    monkeypatch.setattr(widen_module, "_rename", real)
    assert state.widen("progress", {"table_name": "orders"}, location)
    check_moved(spark, state)
    assert not state.widen("progress", {"table_name": "orders"}, location)
    if located:
        assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["progress"]
        check_moved(spark, StateStore(spark, lake.database).create())
