"""Copies by groups of source files, the kept list, the table of ids, and claims."""

import os

import pytest
from pyspark.sql import functions as F

from grovelift import run_table
from grovelift.plans import load as load_module
from grovelift.plans.load import _Load
from grovelift.schemas import FILE, ID, PAYLOAD
from grovelift.sources.claims import OPEN, Claim, Claims, TableBusy
from grovelift.sources.files import TargetTable, read_source
from tests.test_load import EXPECTED_LOG, EXPECTED_ROWS
from tests.trees import TREE, ids, source_frame


@pytest.fixture
def run(lake, clock):
    def call(table="files", **options):
        options = {"batch_size": 2, "excluded_id": "x", "clock": clock} | options
        return run_table(lake.state, table, lake.name("allowed"), **options)

    return call


@pytest.fixture
def copies(monkeypatch):
    """The parts that a load reads, and the frames that read them."""
    seen, original = [], _Load._rows_of

    def watched(self, part, keys, in_files):
        rows = original(self, part, keys, in_files)
        seen.append((part, in_files, rows))
        return rows

    monkeypatch.setattr(_Load, "_rows_of", watched)
    return seen


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df) -> int:
    """Files that a scan of the payload opens."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    scans = [leaf for leaf in found if PAYLOAD in leaf.toString() and "FileScan" in leaf.toString()]
    assert scans
    return sum(leaf.metrics().apply("numFiles").value() for leaf in scans)


@pytest.fixture
def no_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


# -- groups of files


def test_each_payload_file_is_read_once(lake, run, copies, no_adaptive, monkeypatch):
    monkeypatch.setattr(load_module, "PART_BYTES", 100)  # two keys
    target = lake.add_table("files")
    source = read_source(lake.spark, lake.name("files_src"), with_file=True)
    wanted = {r[0] for r in EXPECTED_ROWS if r[1]}
    per_file = source.where(F.col(ID).isin(*wanted)).select(FILE).distinct().count()
    run()
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert len(copies) > 3 and all(in_files for _, in_files, _ in copies)
    assert sum(part.files for part, _, _ in copies) == per_file
    assert sum(files_read(rows) for *_, rows in copies) == per_file


def test_payload_of_many_keys_is_not_exchanged(spark, lake, run, copies, monkeypatch):
    """Thrice the keys of a broadcast: three parts, each with keys of its own."""
    n, at = 3000, F.lit("2026-01-01").cast("timestamp_ntz")
    id_ = F.format_string("%08d", "id")
    flags = [F.lit(False).alias(c) for c in source_frame(spark, TREE).columns if c.startswith("is_")]
    rows = spark.range(0, n, 1, 6).select(
        id_.alias(ID), F.encode(id_, "utf-8").alias(PAYLOAD), id_.alias("name"), id_.alias("path_locator"),
        *[at.alias(c) for c in ("creation_time", "last_write_time", "last_access_time")],
        *flags, F.lit(None).cast("string").alias("parent_path_locator"),
    )
    target = lake.add_table("files", held=[])
    lake.put("files_src", rows)
    lake.put("files_meta", rows.select(F.col(ID).alias("file_id"), F.lit(1).alias("OwningBusinessUnit")))
    monkeypatch.setattr(load_module, "PART_BYTES", n * 56 // 3)
    monkeypatch.setattr(load_module, "ROWS_PER_FILE", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert run(excluded_id=None).rows[1] == n
        texts = [plan(rows) for *_, rows in copies]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(texts) == 3 and target.rows().count() == n
    for text in texts:
        above = text[: text.index("FileScan")]
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        assert "Exchange hashpartitioning" not in above and "REBALANCE" not in text


def test_batches_stay_in_id_order(lake, run, monkeypatch):
    monkeypatch.setattr(load_module, "PART_BYTES", 60)
    monkeypatch.setattr(load_module, "CHUNK_PARTS", 2)
    target = lake.add_table("files")
    result = run()
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log(result.run_id, "files") == EXPECTED_LOG
    assert len(target.chunks(result.run_id, 1)) > 2


def test_a_source_without_files(lake, run):
    """A view over values has no file names; parts are made by position."""
    target = lake.add_table("files")
    lake.spark.sql(f"DROP TABLE {lake.database}.files_src")
    text = ", ".join(
        f"('{i}', X'00', 'n', '{p}', {'NULL' if up is None else repr(up)})" for i, p, up, _ in TREE
    )
    times = ", ".join(f"TIMESTAMP_NTZ '2020-01-01' AS {c}" for c in ("creation_time", "last_write_time", "last_access_time"))
    flags = [c for c in source_frame(lake.spark, TREE).columns if c.startswith("is_")]
    lake.spark.sql(
        f"CREATE VIEW {lake.database}.files_src AS SELECT *, {times}, "
        f"{', '.join(f'false AS {c}' for c in flags)} FROM VALUES {text} AS "
        "t(stream_id, file_stream, name, path_locator, parent_path_locator)"
    )
    result = run(chunk_rows=3)
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log(result.run_id, "files") == EXPECTED_LOG
    assert len(target.chunks(result.run_id, 1)) > 2


# -- resuming


def test_a_resume_copies_the_open_groups_only(lake, run, copies, monkeypatch):
    """It neither looks for rows again nor reads files whose group is done."""
    monkeypatch.setattr(load_module, "PART_BYTES", 100)
    monkeypatch.setattr(load_module, "CHUNK_PARTS", 1)
    target = lake.add_table("files")
    commit, done = _Load._commit, []

    def failing(self, work, parts, *rest):
        if len(done) == 2:
            raise RuntimeError("lost the driver")
        commit(self, work, parts, *rest)
        done.append(parts[0].number)

    with monkeypatch.context() as patch:
        patch.setattr(_Load, "_commit", failing)
        with pytest.raises(RuntimeError, match="lost the driver"):
            run(run_id="R")
    first = [part.number for part, *_ in copies]
    assert first[:2] == done and len(first) == 3
    assert len(target.chunks("R", 1)) == 2  # what was not committed is gone
    copies.clear()
    monkeypatch.setattr(_Load, "_label", lambda *_: pytest.fail("rows are looked for again"))
    run(run_id="R")
    assert not {part.number for part, *_ in copies} & set(done)
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert [r for r in lake.log("R", "files") if r[4] != "Failed"] == EXPECTED_LOG


def test_nothing_is_left_behind(lake, run, spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    lake.add_table("files")
    left = set(os.listdir(folder))  # an upsert of definitions has none of its own
    result = run()
    assert set(os.listdir(folder)) == left >= before
    for table in ("work_list", "work_rounds"):
        assert spark.sql(f"SHOW PARTITIONS {lake.state.name(table)}").count() == 0
    assert lake.state.copied(result.run_id, "files", 1).count() > 0


def test_a_rewritten_source_is_searched_as_a_whole(lake, run, copies, monkeypatch):
    """The files of the kept list are gone; the rows are found where they are now."""
    target = lake.add_table("files")
    with monkeypatch.context() as patch:
        patch.setattr(_Load, "_write_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            run(run_id="R")
    lake.put("files_src", source_frame(lake.spark, TREE).coalesce(2))
    assert run(run_id="R").rows == {1: 1, 2: 4, 3: 5}
    assert [in_files for _, in_files, _ in copies] == [True, False]
    assert lake.held_columns(target) == EXPECTED_ROWS


# -- what was drawn and what was written


def test_one_id_gone_and_another_twice_is_not_committed(lake, run, monkeypatch):
    target = lake.add_table("files")
    with monkeypatch.context() as patch:
        patch.setattr(_Load, "_write_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            run(run_id="R")
    changed = [n for n in TREE if n[0] != "b"] + [n for n in TREE if n[0] == "d"]
    lake.put("files_src", source_frame(lake.spark, changed))
    with pytest.raises(ValueError, match="several rows with one id"):
        run(run_id="R")
    assert {r[4] for r in lake.log("R", "files")} == {"Failed"}
    assert ids(target.rows()) == ["j"] and target.chunks("R", 1) == set()


def test_an_id_in_two_files_is_not_committed(lake, run):
    lake.add_table("files")
    rows = source_frame(lake.spark, [*TREE, TREE[0]]).repartition(8, "name", F.rand(1))
    lake.put("files_src", rows)
    with pytest.raises(ValueError, match="several rows with one id"):
        run(run_id="R")
    assert {r[4] for r in lake.log("R", "files")} == {"Failed"}


# -- the table of ids


def test_the_target_is_not_exchanged(lake, run, spark, monkeypatch):
    lake.add_table("files")
    seen, label = [], _Load._label

    def watched(self, *args):
        seen.append(label(self, *args))
        return seen[-1]

    monkeypatch.setattr(_Load, "_label", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        run()
        text = plan(seen[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tail = text[text.index("LeftAnti") :]
    lines = tail.splitlines()
    scan = next(i for i, line in enumerate(lines) if "files_tgt_ids" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
    above = [line for line in lines[:scan] if "Exchange" in line]
    assert "Bucketed: true" in lines[scan]
    # the only exchange below the join belongs to the labels, in as many parts as buckets
    assert all("REPARTITION_BY_NUM" in line or line.index("Exchange") > depth for line in above[:1])
    last = max(i for i, line in enumerate(lines[:scan]) if "Sort " in line or "LeftAnti" in line)
    assert not any("Exchange" in line for line in lines[last:scan])


def test_crash_between_the_target_and_its_ids(lake, run, monkeypatch):
    monkeypatch.setattr(load_module, "PART_BYTES", 100)
    monkeypatch.setattr(load_module, "CHUNK_PARTS", 2)
    target = lake.add_table("files")
    write, calls = TargetTable._write_ids, []

    def failing(self, place):
        calls.append(place)
        if len(calls) == 2:
            raise RuntimeError("lost the driver")
        write(self, place)

    with monkeypatch.context() as patch:
        patch.setattr(TargetTable, "_write_ids", failing)
        patch.setattr(_Load, "give_up", lambda self: None)  # as if the process had died
        with pytest.raises(RuntimeError, match="lost the driver"):
            run(run_id="R")
    run(run_id="R")
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert ids(target.held_ids()) == ids(target.rows())


def test_ids_of_an_older_target_are_made_up_for(lake, run, spark):
    target = lake.add_table("files")
    spark.sql(f"DROP TABLE {target.ids_name}")
    assert run().rows == {1: 1, 2: 4, 3: 5}
    assert ids(target.held_ids()) == ids(target.rows())


# -- two runs of one table


def test_the_second_of_two_runs_fails(lake, run, monkeypatch):
    target = lake.add_table("files")
    write, met = _Load._write_rows, []

    def meanwhile(self, *args):
        if not met:
            met.append(1)
            with pytest.raises(TableBusy):
                run(run_id="SECOND")
        return write(self, *args)

    monkeypatch.setattr(_Load, "_write_rows", meanwhile)
    run(run_id="FIRST")
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log("FIRST", "files") == EXPECTED_LOG
    assert {r[4] for r in lake.log("SECOND", "files")} == {"Failed"}


def test_a_run_that_is_taken_over_cannot_commit(lake, run, monkeypatch):
    """The first run was thought dead, and goes on after the second has ended."""
    target = lake.add_table("files")
    write, met = _Load._write_rows, []

    def meanwhile(self, *args):
        if not met:
            met.append(1)
            run(run_id="SECOND", take_over=True)
        return write(self, *args)

    monkeypatch.setattr(_Load, "_write_rows", meanwhile)
    with pytest.raises(TableBusy):
        run(run_id="FIRST")
    assert lake.held_columns(target) == EXPECTED_ROWS
    assert lake.log("SECOND", "files") == EXPECTED_LOG
    assert {r[4] for r in lake.log("FIRST", "files")} == {"Failed"}
    # resumed, it finds its rows loaded
    assert run(run_id="FIRST").rows == {1: 0, 2: 0, 3: 0}
    assert lake.held_columns(target) == EXPECTED_ROWS


def test_a_run_between_two_chunks_of_another(lake, run, monkeypatch):
    monkeypatch.setattr(load_module, "PART_BYTES", 100)
    monkeypatch.setattr(load_module, "CHUNK_PARTS", 1)
    target = lake.add_table("files")
    commit, met = _Load._commit, []

    def meanwhile(self, *args):
        commit(self, *args)
        if not met:
            met.append(1)
            run(run_id="SECOND")

    monkeypatch.setattr(_Load, "_commit", meanwhile)
    with pytest.raises(TableBusy):
        run(run_id="FIRST")
    assert [r[:2] for r in lake.held_columns(target)] == [r[:2] for r in EXPECTED_ROWS]
    run(run_id="FIRST")
    assert [r[:2] for r in lake.held_columns(target)] == [r[:2] for r in EXPECTED_ROWS]
    assert {r[4] for r in lake.log("FIRST", "files")} == {"Failed", "InProgress", "Completed"}


def test_claims(spark, tmp_path):
    one, two = (Claims(spark, str(tmp_path / "claims")) for _ in range(2))
    assert one.head() == Claim(0)
    assert one.make(Claim(1, OPEN, "R", 1, 1)) and not two.make(Claim(1, OPEN, "S", 1, 1))
    assert two.head() == Claim(1, OPEN, "R", 1, 1) and two.head().of("R", 1)
    for version in range(2, 60):
        assert two.make(Claim(version, OPEN, "S", 1, version))
    assert not one.make(Claim(3, OPEN, "R", 1, 3))  # long gone, but passed
    assert len(os.listdir(tmp_path / "claims")) < 60
