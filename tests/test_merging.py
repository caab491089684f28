"""Many small partitions of ids and of marks become few."""

import pytest

from grovelift import run_table
from grovelift.plans import load as load_module
from grovelift.plans.load import _Load
from grovelift.sources import files as files_module
from grovelift.sources import state as state_module
from grovelift.sources.catalog import partitions_of
from grovelift.sources.files import TargetTable
from grovelift.sources.merged_ids import MergedIds, level_of, merged_place, next_place
from grovelift.sources.state import StateStore
from tests.test_load import EXPECTED_LOG, EXPECTED_ROWS
from tests.test_plans import scans
from tests.trees import TREE, ids, source_frame


def of_ids(target) -> list[tuple]:
    return sorted(partitions_of(target.spark, target.ids_name, TargetTable.PARTITIONS))


def levels(target) -> list[int]:
    return sorted(level_of(p) for p in of_ids(target) if p[0] != files_module.INITIAL_RUN)


def parts(spark, n):
    """The tree in n parts."""
    return [source_frame(spark, TREE[i::n]) for i in range(n)]


@pytest.fixture
def target(lake):
    """Seven chunks of three runs."""
    target = TargetTable(lake.spark, lake.name("tgt")).create(id_buckets=2)
    for number, rows in enumerate(parts(lake.spark, 7)):
        rows = rows.selectExpr("*", "cast(1 as short) AS _step", "1 AS _batch")
        target.write_chunk(f"R{number % 3}", 1, number, rows)
    return target


ALL = sorted(node[0] for node in TREE)


def test_places():
    assert level_of(("R", "1", "5")) == 0 and level_of(("merged", "1", "5")) == 0
    assert level_of(merged_place(3, 8)) == 3
    assert next_place(2, {merged_place(2, 8), merged_place(1, 9)}) == merged_place(2, 9)


def test_levels(target):
    assert target.many_ids(fan_in=3) and not target.many_ids(fan_in=8)
    target.merge_ids(fan_in=8)
    assert levels(target) == [0] * 7
    target.merge_ids(fan_in=3)
    assert levels(target) == [1] and not target.many_ids(fan_in=3)
    assert ids(target.held_ids()) == ids(target.rows()) == ALL
    for number in range(7, 13):
        rows = source_frame(target.spark, [(f"n{number}", "/n/", None)])
        target.write_chunk("S", 1, number, rows.selectExpr("*", "cast(1 as short) AS _step", "1 AS _batch"))
        if number % 3 == 0:
            target.merge_ids(fan_in=3)
    # 7 to 9 and 10 to 12 were merged, and then with the first ones
    assert levels(target) == [2]
    assert ids(target.held_ids()) == ids(target.rows())
    target.complete_ids()
    assert levels(target) == [2]


def test_a_merged_partition_has_a_file_per_bucket(target):
    target.merge_ids(fan_in=3)
    rows = target.held_ids()
    assert len(rows.inputFiles()) <= target.buckets() == 2
    (scan,) = scans(rows.groupBy("stream_id").count())
    assert "Bucketed: true" in scan


def test_initial_rows_stay(target):
    target.load_initial(source_frame(target.spark, [("old", "/o/", None)]))
    target.merge_ids(fan_in=3)
    assert (files_module.INITIAL_RUN, "0", "0") in of_ids(target) and len(of_ids(target)) == 2
    assert ids(target.held_ids()) == sorted([*ALL, "old"])


def test_a_chunk_that_leaves_the_target(target):
    """It had been merged; the others then stand for themselves, or are merged anew."""
    target.merge_ids(fan_in=3)
    target.drop_chunk("R1", 1, 4)
    target.complete_ids()
    assert levels(target) == [0] * 6
    assert ids(target.held_ids()) == ids(target.rows()) != ALL
    target.merge_ids(fan_in=3)
    assert levels(target) == [1]
    assert ids(target.held_ids()) == ids(target.rows())


@pytest.mark.parametrize("place", ["write", "complete_ids"])
def test_crash_while_merging(target, monkeypatch, place):
    """Before the list is kept, and between the list and the removal."""

    def failing(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(MergedIds if place == "write" else TargetTable, place, failing)
        with pytest.raises(RuntimeError, match="lost the driver"):
            target.merge_ids(fan_in=3)
    assert set(ids(target.held_ids())) == set(ALL)
    target.complete_ids()
    assert levels(target) == ([0] * 7 if place == "write" else [1])
    assert ids(target.held_ids()) == ALL


@pytest.fixture
def small(monkeypatch):
    """Chunks of two rows, merged by threes."""
    monkeypatch.setattr(load_module, "PART_BYTES", 100)
    monkeypatch.setattr(load_module, "CHUNK_PARTS", 1)
    monkeypatch.setattr(state_module, "FAN_IN", 3)
    merge, many = TargetTable.merge_ids, TargetTable.many_ids
    monkeypatch.setattr(TargetTable, "merge_ids", lambda self: merge(self, 3))
    monkeypatch.setattr(TargetTable, "many_ids", lambda self: many(self, 3))


def marks(lake, run_id) -> list[int]:
    columns = ("run_id", "chunk")
    held = partitions_of(lake.spark, lake.state.name("copied"), columns)
    return sorted(int(c) for run, c in held if run == run_id)


def test_loads_merge(lake, clock, small):
    target = lake.add_table("files")
    options = {"batch_size": 2, "excluded_id": "x", "clock": clock}
    first = run_table(lake.state, "files", lake.name("allowed"), **options)
    n_chunks = len(target.chunks(first.run_id, 1))
    assert n_chunks > 3 and marks(lake, first.run_id) == [-1]
    marked = {r["chunk"] for r in lake.state.copied(first.run_id, "files", 1).collect()}
    assert marked == target.chunks(first.run_id, 1)
    assert levels(target) == [0] * n_chunks  # of this load, until the next one
    again = run_table(lake.state, "files", lake.name("allowed"), **options)
    assert again.rows == {1: 0, 2: 0, 3: 0} and levels(target) == [1]
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log(first.run_id, "files") == EXPECTED_LOG
    assert ids(target.held_ids()) == ids(target.rows())


def test_crash_while_marks_are_merged(lake, clock, small, monkeypatch):
    """Marks are there twice, and count once; the run goes on to its end."""
    target = lake.add_table("files")
    options = {"batch_size": 2, "excluded_id": "x", "clock": clock, "run_id": "R"}

    def failing(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(state_module, "drop_partition", failing)
        patch.setattr(_Load, "give_up", lambda self: None)
        with pytest.raises(RuntimeError, match="lost the driver"):
            run_table(lake.state, "files", lake.name("allowed"), **options)
    assert marks(lake, "R")[0] == -1 and len(marks(lake, "R")) > 3
    rows = lake.state.copied("R", "files", 1).collect()
    assert len(rows) == len({(r["round"], r["part"]) for r in rows})
    assert run_table(lake.state, "files", lake.name("allowed"), **options).rows == {1: 0, 2: 0, 3: 0}
    assert lake.held_columns(target) == EXPECTED_ROWS


def test_crash_while_a_load_merges(lake, clock, small, monkeypatch):
    """The claim that it had opened is closed when the run is resumed."""
    target = lake.add_table("files")
    options = {"batch_size": 2, "excluded_id": "x", "clock": clock}
    run_table(lake.state, "files", lake.name("allowed"), **options)

    def failing(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(MergedIds, "write", failing)
        patch.setattr(_Load, "give_up", lambda self: None)  # as if the process had died
        with pytest.raises(RuntimeError, match="lost the driver"):
            run_table(lake.state, "files", lake.name("allowed"), run_id="R", **options)
    assert run_table(lake.state, "files", lake.name("allowed"), run_id="R", **options).rows == {1: 0, 2: 0, 3: 0}
    assert lake.held_columns(target) == EXPECTED_ROWS and levels(target) == [1]
    assert ids(target.held_ids()) == ids(target.rows())


def test_tables_with_a_place_of_their_own(spark, lake, clock, small, tmp_path):
    """Their partitions go with their files, and a catalog that forgets them finds the list."""
    lake.state = StateStore(spark, f"{lake.database}_state").create(str(tmp_path / "state"))
    place = str(tmp_path / "tgt")
    TargetTable(spark, lake.name("files_tgt")).create(place, id_buckets=2)
    target = lake.add_table("files")
    options = {"batch_size": 2, "excluded_id": "x", "clock": clock}
    first = run_table(lake.state, "files", lake.name("allowed"), **options)
    assert marks(lake, first.run_id) == [-1]
    n_chunks = len(target.chunks(first.run_id, 1))
    run_table(lake.state, "files", lake.name("allowed"), **options)
    assert levels(target) == [1] and ids(target.held_ids()) == ids(target.rows())
    assert len(list((tmp_path / "tgt_ids").glob("*/*/_chunk=*"))) == 2 < n_chunks
    for name in (target.name, target.ids_name, target.merged.name):
        spark.sql(f"DROP TABLE {name}")
    target = TargetTable(spark, lake.name("files_tgt")).create(place, id_buckets=2)
    target.complete_ids()
    assert levels(target) == [1] and ids(target.held_ids()) == ids(target.rows())
    assert lake.held_columns(target) == EXPECTED_ROWS
    run_table(lake.state, "files", lake.name("allowed"), run_id=first.run_id, reset=True, **options)
    assert lake.held_columns(target) == EXPECTED_ROWS
