"""Steps over few rows take few tasks, also where many shuffle partitions are set and none are merged."""

from __future__ import annotations

from itertools import count

import pytest

from grovelift.llm.components import components
from grovelift.llm.toxicity import fit_toxicity

PARTITIONS = 32
_groups = count()


@pytest.fixture
def tasks_of(spark):
    """Calls a function with many shuffle partitions; its result and the number of tasks it took."""
    many = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in many}

    def run(function):
        context, group = spark.sparkContext, f"small steps {next(_groups)}"
        context.setJobGroup(group, group)
        result = function()
        context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        found = filter(None, map(tracker.getStageInfo, stages))
        return result, sum(s.numCompletedTasks for s in found)

    for key, value in many.items():
        spark.conf.set(key, value)
    yield run
    for key, value in before.items():
        spark.conf.set(key, value)
    for key in ("spark.jobGroup.id", "spark.job.description"):
        spark.sparkContext.setLocalProperty(key, None)


def test_trees_over_a_sample(spark, documents, tasks_of):
    rows = documents([(i, ("you rotten fool " if i % 3 == 0 else "a fine day ") * (1 + i % 5)) for i in range(400)])
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    model, tasks = tasks_of(lambda: fit_toxicity(rows, labels))
    assert tasks < 40 * PARTITIONS  # with a task per partition in each pass over the sample: 1,967
    scores = {r.doc_id: r.score for r in model.score(rows, ["doc_id"]).select("row.doc_id", "score").collect()}
    assert all((score >= 0.5) == (i % 3 == 0) for i, score in scores.items()) and len(scores) == 400


def test_stars_take_no_round(spark, tasks_of):
    pairs = spark.createDataFrame([(10 * i, 10 * i + j) for i in range(20) for j in range(1, 10)], "a long, b long")
    found, tasks = tasks_of(lambda: components(pairs))
    assert tasks < 8 * PARTITIONS  # with a round that only finds nothing to change: 522
    assert dict(map(tuple, found.collect())) == {i: i // 10 * 10 for i in range(200)}


def test_edges_that_are_no_stars_yet(spark):
    cases = {
        "a larger end with two edges": [(1, 3), (2, 3)],
        "a larger end that is a smaller one too": [(1, 2), (2, 3)],
        "both": [(5, 9), (4, 9), (9, 12), (3, 4), (20, 21)],
    }
    expected = [{1: 1, 2: 1, 3: 1}, {1: 1, 2: 1, 3: 1}, {3: 3, 4: 3, 5: 3, 9: 3, 12: 3, 20: 20, 21: 20}]
    for rows, nodes in zip(cases.values(), expected, strict=True):
        found = components(spark.createDataFrame(rows, "a long, b long")).collect()
        assert sorted(map(tuple, found)) == sorted(nodes.items())
