"""The three steps as pure functions, on a hand-made tree."""

import pytest
from pyspark.sql import functions as F

from grovelift.operators import (
    children,
    direct_parents,
    fetch_rows,
    in_scope,
    label_rows,
    missing_parents,
    roots,
    scope_ids,
)
from grovelift.operators.sizing import Size
from grovelift.schemas import FILE_COLUMNS
from tests.trees import (
    ALLOWED,
    EXCLUDED,
    HELD,
    TREE,
    allowed_frame,
    copied,
    id_frame,
    ids,
    metadata_frame,
    source_frame,
)


@pytest.fixture(scope="module")
def tree(spark):
    scope = scope_ids(metadata_frame(spark, TREE), allowed_frame(spark, ALLOWED), "file_id")
    return source_frame(spark, TREE).cache(), scope


def by_step(labels):
    found = {}
    for row in labels.collect():
        found.setdefault(row.step, []).append(row.stream_id)
    return {step: sorted(v) for step, v in found.items()}


def test_scope_needs_an_owner_on_the_list(tree):
    source, scope = tree
    assert ids(scope) == list("acdefijnx")
    assert ids(in_scope(source, scope, EXCLUDED)) == list("acdefijn")
    assert ids(in_scope(source, scope)) == list("acdefijnx")


def test_double_metadata_and_double_owners_do_not_multiply_rows(spark, tree):
    source, _ = tree
    meta = metadata_frame(spark, TREE)
    twice = scope_ids(meta.unionAll(meta), allowed_frame(spark, ALLOWED * 2), "file_id")
    assert ids(in_scope(source, twice, EXCLUDED)) == list("acdefijn")


def test_steps_in_order(spark, tree):
    source, scope = tree
    held = id_frame(spark, HELD)
    assert ids(roots(source, scope, held, EXCLUDED)) == ["a"]
    held = held.unionAll(id_frame(spark, ["a"]))
    assert ids(direct_parents(source, scope, EXCLUDED)) == list("abdgkx")
    assert ids(missing_parents(source, scope, held, EXCLUDED)) == list("bdgk")
    held = held.unionAll(id_frame(spark, list("bdgk")))
    assert ids(children(source, scope, held, EXCLUDED)) == list("cefin")


def test_one_pass_gives_the_same_steps(spark, tree):
    source, scope = tree
    held = id_frame(spark, HELD)
    labels = label_rows(source, scope, held, EXCLUDED)
    assert by_step(labels) == {1: ["a"], 2: list("bdgk"), 3: list("cefin")}


def test_one_pass_over_open_steps_only(spark, tree):
    source, scope = tree
    held = id_frame(spark, HELD)
    # Step 1 is over: its row is found again only where a child needs it.
    assert by_step(label_rows(source, scope, held, EXCLUDED, {2, 3})) == {
        2: list("abdgk"),
        3: list("cefin"),
    }
    assert by_step(label_rows(source, scope, held, EXCLUDED, {3})) == {3: list("cdefin")}
    queue = id_frame(spark, ["b", "d", "gone"])
    assert by_step(label_rows(source, scope, held, EXCLUDED, {2, 3}, queue)) == {
        2: ["b", "d", "gone"],
        3: list("cefin"),
    }


def test_without_an_excluded_id(spark, tree):
    source, scope = tree
    labels = label_rows(source, scope, id_frame(spark, HELD))
    assert by_step(labels) == {1: ["a", "x"], 2: list("bdgk"), 3: list("cefin")}


def test_fetch_copies_14_columns(spark, tree):
    source, _ = tree
    keys = id_frame(spark, ["a", "m", "gone"]).withColumn("_step", F.lit(1))
    for size in (None, Size(3, 10), Size(3, 10**9), Size(10**9, 10**9), Size(10**9, 10**12)):
        rows = fetch_rows(source, keys, size)
        assert rows.columns == [*FILE_COLUMNS, "_step"]
        got = sorted(tuple(r)[:-1] for r in rows.collect())
        assert [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in got] == (
            copied(TREE, ["a", "m"])
        )
