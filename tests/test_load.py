"""Whole loads: results, log, resume, reset, failure."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from grovelift import TableConfig, run_all, run_table
from grovelift.plans.config import load_active, upsert_config
from grovelift.plans.load import _Load
from grovelift.plans.scripts import seed_scripts
from grovelift.sources.state import StateStore
from tests.trees import TREE, copied, file_row, ids, source_frame

EXPECTED_LOG = [
    (1, 1, 1, 1, "InProgress"),
    (1, 2, 0, 1, "InProgress"),
    (1, 0, 0, 1, "Completed"),
    (2, 1, 2, 2, "InProgress"),
    (2, 2, 2, 4, "InProgress"),
    (2, 0, 0, 4, "Completed"),
    (3, 1, 2, 2, "InProgress"),
    (3, 2, 2, 4, "InProgress"),
    (3, 3, 1, 5, "InProgress"),
    (3, 4, 0, 5, "InProgress"),
    (3, 0, 0, 5, "Completed"),
]
EXPECTED_ROWS = [
    ("a", 1, 1),
    ("b", 2, 1),
    ("c", 3, 1),
    ("d", 2, 1),
    ("e", 3, 1),
    ("f", 3, 2),
    ("g", 2, 2),
    ("i", 3, 2),
    ("j", 0, 0),
    ("k", 2, 2),
    ("n", 3, 3),
]


@pytest.fixture
def run(lake, clock):
    def call(table="files", **options):
        options = {"batch_size": 2, "excluded_id": "x", "clock": clock} | options
        return run_table(lake.state, table, lake.name("allowed"), **options)

    return call


@pytest.mark.parametrize(
    "options", [{}, {"chunk_rows": 2}, {"chunk_rows": 4}, {"settle": True}, {"guid_ids": True}]
)
def test_hand_made_tree(lake, run, options):
    target = lake.add_table("files")
    result = run(**options)
    assert result.rows == {1: 1, 2: 4, 3: 5}
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log(result.run_id, "files") == EXPECTED_LOG
    queue = lake.state.queue(result.run_id, "files")
    assert queue.columns == ["run_id", "table_name", "stream_id", "processed", "created_at"]
    assert sorted((r.stream_id, r.processed) for r in queue.collect()) == [
        (i, True) for i in "bdgk"
    ]
    rows = sorted(tuple(r) for r in target.rows().collect())
    plain = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows]
    assert plain == copied(TREE, "abcdefgijkn")


def test_scripts_give_the_same_load(lake, run):
    target = lake.add_table("files")
    with pytest.raises(KeyError):
        run(scripted=True)
    seed_scripts(lake.state, ["files"])
    result = run(scripted=True)
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log(result.run_id, "files") == EXPECTED_LOG


def test_second_run_adds_nothing(lake, run):
    target = lake.add_table("files")
    run()
    again = run()
    assert again.rows == {1: 0, 2: 0, 3: 0}
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert [r for r in lake.log(again.run_id, "files") if r[2]] == []
    assert len(lake.log(again.run_id, "files")) == 5  # two empty batches, three completions


def test_finished_run_is_left_alone(lake, run):
    lake.add_table("files")
    first = run()
    log = lake.log(first.run_id, "files")
    again = run(run_id=first.run_id)
    assert again.rows == {1: 0, 2: 0, 3: 0}
    assert lake.log(first.run_id, "files") == log


def test_new_rows_come_with_the_next_run(lake, run):
    target = lake.add_table("files")
    run()
    more = [("o", "/7/", None, 3), ("p", "/7/1/", "/7/", 3)]
    lake.put("files_src", source_frame(lake.spark, more), "append")
    meta = lake.spark.createDataFrame(
        [("o", 3), ("p", 3)], "file_id string, OwningBusinessUnit int"
    )
    lake.put("files_meta", meta, "append")
    assert run().rows == {1: 1, 2: 0, 3: 1}
    assert {"o", "p"} <= set(ids(target.rows()))


def test_settle_takes_rows_that_arrive_during_the_run(lake, run, monkeypatch):
    lake.add_table("files")
    write = _Load._write_rows
    calls = []

    def arriving(self, work, spans, chunk):
        out = write(self, work, spans, chunk)
        if not calls:
            rows = source_frame(lake.spark, [("o", "/7/", None, 3)])
            lake.put("files_src", rows, "append")
            meta = lake.spark.createDataFrame(
                [("o", 3)], "file_id string, OwningBusinessUnit int"
            )
            lake.put("files_meta", meta, "append")
        calls.append(chunk)
        return out

    monkeypatch.setattr(_Load, "_write_rows", arriving)
    result = run(settle=True)
    assert result.rows == {1: 2, 2: 4, 3: 5}
    log = [r for r in lake.log(result.run_id, "files") if r[0] == 1]
    assert log == [
        (1, 1, 1, 1, "InProgress"),
        (1, 2, 1, 2, "InProgress"),
        (1, 3, 0, 2, "InProgress"),
        (1, 0, 0, 2, "Completed"),
    ]


@pytest.mark.parametrize("chunk_rows, fail_at", [(None, 1), (2, 1), (2, 3), (4, 3)])
@pytest.mark.parametrize("after_write", [False, True])
def test_crash_and_resume_equals_an_undisturbed_run(
    lake, run, monkeypatch, chunk_rows, fail_at, after_write
):
    """Fail in the data write, or between the data write and the log write."""
    target = lake.add_table("files")
    name = "_commit" if after_write else "_write_rows"
    original = getattr(_Load, name)
    calls = []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == fail_at:
            if not after_write:
                original(self, *args)
            raise RuntimeError("lost the driver")
        return original(self, *args)

    monkeypatch.setattr(_Load, name, failing)
    run_id = "RUN'1"
    with pytest.raises(RuntimeError, match="lost the driver"):
        run(run_id=run_id, chunk_rows=chunk_rows)
    failures = lake.state.progress(run_id, "files").where("status = 'Failed'").collect()
    assert [(f.batch_number, f.failure_number, f.error_message) for f in failures] == [
        (999999, 1, "lost the driver")
    ]
    run(run_id=run_id, chunk_rows=chunk_rows)
    assert lake.held_columns(target) == EXPECTED_ROWS
    log = [r for r in lake.log(run_id, "files") if r[4] != "Failed"]
    assert log == EXPECTED_LOG


def test_repeated_failures_keep_their_own_rows(lake, run, monkeypatch):
    lake.add_table("files")

    def failing(self, *args):
        raise RuntimeError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(_Load, "_write_rows", failing)
        for _ in range(3):
            with pytest.raises(RuntimeError, match="no space"):
                run(run_id="R")
    failed = lake.state.progress("R", "files").collect()
    assert sorted(r.failure_number for r in failed) == [1, 2, 3]
    assert run(run_id="R").rows == {1: 1, 2: 4, 3: 5}


def test_reset_keeps_rows_and_start_time(lake, run):
    target = lake.add_table("files")
    first = run()
    started = lake.state.progress(first.run_id, "files").first().run_started_at
    again = run(run_id=first.run_id, reset=True)
    assert again.rows == {1: 0, 2: 0, 3: 0}
    assert lake.held_columns(target) == EXPECTED_ROWS
    log = lake.log(first.run_id, "files")
    assert len(log) == 5 and not any(r[2] for r in log)
    assert lake.state.queue(first.run_id, "files").count() == 0
    assert lake.state.progress(first.run_id, "files").first().run_started_at == started


def test_reset_of_one_table_leaves_others(lake, run):
    lake.add_table("files")
    lake.add_table("other")
    one, two = run_all(
        lake.state, ["files", "other"], lake.name("allowed"), batch_size=2, excluded_id="x"
    )
    assert one.run_id == two.run_id and one.rows == two.rows == {1: 1, 2: 4, 3: 5}
    run(run_id=one.run_id, reset=True)
    assert lake.log(one.run_id, "other") == EXPECTED_LOG
    assert lake.state.queue(one.run_id, "other").count() == 4


def test_reset_without_run_id_is_an_error(lake, run):
    lake.add_table("files")
    with pytest.raises(ValueError, match="reset"):
        run(reset=True)


def test_unknown_or_inactive_table_is_an_error(lake, run):
    lake.add_table("files")
    with pytest.raises(ValueError, match="nothing"):
        run(table="nothing")
    off = lake.config_rows("off").withColumn("is_active", F.lit(False))
    lake.state.upsert("table_config", off, [], {"created_at": F.localtimestamp()})
    with pytest.raises(ValueError, match="off"):
        run(table="off")
    assert lake.spark.table(f"{lake.database}.progress").count() == 0
    assert load_active(lake.state, "files") == TableConfig(
        "files", lake.name("files_src"), lake.name("files_tgt"), lake.name("files_meta"), "file_id"
    )


def test_queued_parents_that_left_the_source(lake, run, monkeypatch):
    """They are drawn from the queue and logged as a batch with fewer rows."""
    target = lake.add_table("files")

    def failing(self, *args):
        raise RuntimeError("stop")

    with monkeypatch.context() as patch:
        patch.setattr(_Load, "_write_rows", failing)
        with pytest.raises(RuntimeError):
            run(run_id="R")
    assert [r.processed for r in lake.state.queue("R", "files").collect()] == [False] * 4
    left = [n for n in TREE if n[0] not in "bd"]
    lake.put("files_src", source_frame(lake.spark, left))
    assert run(run_id="R").rows == {1: 1, 2: 2, 3: 5}
    steps = [r for r in lake.log("R", "files") if r[0] == 2 and r[4] != "Failed"]
    assert steps == [
        (2, 1, 0, 0, "InProgress"),
        (2, 2, 2, 2, "InProgress"),
        (2, 0, 0, 2, "Completed"),
    ]
    assert all(r.processed for r in lake.state.queue("R", "files").collect())
    assert "b" not in ids(target.rows())


def test_guids_match_by_value(lake, run):
    low, up = "7f8d53ec-b98c-f011-b86b-00000000000a", "7F8D53EC-B98C-F011-B86B-00000000000B"
    tree = [(low, "/1/", None, 1), (up, "/2/", None, 1)]
    target = lake.add_table("files", tree, held=[])
    swapped = lake.spark.createDataFrame(
        [(low.upper(), 1), ("{" + up.lower() + "}", 1)], "file_id string, OwningBusinessUnit int"
    )
    lake.put("files_meta", swapped)
    assert run(excluded_id="{" + low + "}", guid_ids=True).rows[1] == 1
    assert ids(target.rows()) == [up]
    assert run(excluded_id=None, guid_ids=True).rows[1] == 1
    assert ids(target.rows()) == [low.upper(), up]


@pytest.mark.parametrize("scripted", [False, True])
@pytest.mark.parametrize("spelling", [str.lower, str.upper, lambda v: "{" + v.lower() + "}"])
def test_the_excluded_id_counts_by_value(lake, run, scripted, spelling):
    guid = "7F8D53EC-B98C-F011-B86B-00000000000A"
    target = lake.add_table("files", [(guid, "/1/", None, 1), ("r", "/2/", None, 1)], held=[])
    if scripted:
        seed_scripts(lake.state, ["files"])
    assert run(excluded_id=spelling(guid), scripted=scripted).rows == {1: 1, 2: 0, 3: 0}
    assert ids(target.rows()) == ["r"]


def test_the_run_id_counts_by_value(lake, run):
    lake.add_table("files")
    guid = "5C0FFEE0-0000-4000-8000-00000000000A"
    first = run(run_id=guid.lower())
    assert first.run_id == guid
    log = lake.log(guid, "files")
    assert run(run_id="{" + guid + "}").rows == {1: 0, 2: 0, 3: 0}
    assert lake.log(guid.lower(), "files") == log
    assert run(run_id=guid.lower(), reset=True).run_id == guid
    assert lake.state.attempt(guid, "files") == 2


def test_ids_that_differ_in_case_only_stay_apart(lake, run):
    other = "not-a-guid-but-of-the-same-length-xx"
    tree = [(other, "/1/", None, 1), (other.upper(), "/2/", None, 1)]
    target = lake.add_table("files", tree, held=[])
    assert run(excluded_id=None, guid_ids=True).rows[1] == 2
    assert ids(target.rows()) == sorted([other, other.upper()])


def test_a_source_with_a_repeated_id_raises_before_the_commit(lake, run):
    tree = [("a", "/1/", None, 1), ("a", "/1/", None, 1), ("b", "/2/", None, 1)]
    lake.add_table("files", tree, held=[])
    with pytest.raises(ValueError, match="several rows with one id"):
        run(run_id="R")
    assert {row[4] for row in lake.log("R", "files")} == {"Failed"}


def test_old_versions_of_definitions_go(lake):
    for _ in range(4):
        upsert_config(lake.state, lake.config_rows("files"), datetime(2026, 1, 1))
    name = lake.state.name("table_config")
    assert lake.spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    assert lake.state.read("table_config").count() == 1


def test_a_required_value_must_be_there(lake):
    rows = lake.config_rows("files").withColumn("source_table", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="source_table must have a value"):
        upsert_config(lake.state, rows, datetime(2026, 1, 1))


def test_an_error_that_cannot_be_logged_is_still_shown(lake, run, monkeypatch):
    lake.add_table("files")

    def failing(self, *args):
        raise RuntimeError("first")

    def failing_too(self, error):
        raise OSError("second")

    monkeypatch.setattr(_Load, "_write_rows", failing)
    monkeypatch.setattr(_Load, "log_failure", failing_too)
    with pytest.raises(RuntimeError, match="first") as caught:
        run()
    assert "second" in caught.value.__notes__[0]


def test_state_of_an_older_layout_gets_its_new_columns(spark, lake):
    """Rows from before a column was kept read as its default, or as NULL."""
    old = lake.state.name("step_scripts")
    spark.sql(f"DROP TABLE {old}")
    spark.sql(
        f"CREATE TABLE {old} (step_number smallint, script_kind string, script_body string, "
        "description string, version int) USING parquet PARTITIONED BY (version)"
    )
    spark.sql(f"INSERT INTO {old} VALUES (1, 'BatchInsert', 'body', 'text', 1)")
    StateStore(spark, lake.database).create().create()
    (row,) = lake.state.read("step_scripts").collect()
    assert (row.step_number, row.script_body, row.description) == (1, "body", "text")
    assert (row.stage_name, row.use_parameterized_max_dop) == (None, False)
    seed_scripts(lake.state, ["files"])
    stages = lake.state.read("step_scripts").select("stage_name").collect()
    assert sorted(r[0] for r in stages) == ["Children", "MissingParents", "Roots"]


def test_a_fresh_catalog_finds_state_and_target_by_location(spark, lake, run, tmp_path):
    """Tables with a location survive a catalog that forgets them."""
    place = str(tmp_path / "state")
    StateStore(spark, "kept").create(place)
    store = StateStore(spark, "kept")
    assert store.reset("R", "t", datetime(2026, 1, 1)) == 2
    spark.sql("DROP DATABASE kept CASCADE")
    StateStore(spark, "kept").create(place)
    assert store.attempt("R", "t") == 2


def test_rows_keep_every_column(lake, run):
    target = lake.add_table("files")
    run()
    row = target.rows().where("stream_id = 'a'").first()
    assert tuple(row)[2:] == file_row("a", "/1/", None)[2:-1]
