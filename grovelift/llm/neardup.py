"""Near duplicates by bottom-k sketches of one hash function.

1. A document's sketch holds the k least hashes of its shingle set. Documents
   with equal sets are one node from here on.
2. Sketches of sets that are similar enough share at least `least_overlap`
   retained values (but for a chance of 1e-7). Of each sketch it is therefore
   enough to list the rarest values, as many as would have to be missed for the
   overlap to fall below that. Values that very many unlike documents share are
   the last in that order and are hardly ever listed.
3. In each inverted list the most central member, a pivot, is paired with all
   others. Pairs are filtered by set size and by the similarity that the
   sketch of the union estimates, and then confirmed on the full sets.
4. Each node has a home, the pivot it met most often. What tells a node from its
   home is its difference, and what tells two nodes of one home apart follows
   from both differences and what these share. Pairs that are similar whatever
   their differences share all lead to one node of the home, the one with the
   most room; each node is paired with that one. Other similar pairs share enough
   of their differences to meet in lists of the rarest values of these. Similar
   nodes of different homes meet in the lists of step 2. So n near copies of a
   text, similar enough to it or not, take about n pairs, and still no link
   between components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, free_finished
from grovelift.llm.components import components
from grovelift.llm.shingles import digest, shingle_sets

WORDS = 5
PERCENT = 80
SKETCH = 64
MISS = 1e-7
# Ids of this number at most are broadcast (8 bytes each) to spare a shuffle of texts.
BROADCAST_IDS = 1_000_000


def least_overlap(k: int, percent: int, miss: float = MISS) -> int:
    """The overlap that sketches of k values keep at this similarity, but for `miss`."""
    p, below = percent / 100, 0.0
    for t in range(k + 1):
        below += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if below > miss:
            return max(1, t)
    return k


def _sketch_batches(words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, values, edges = [], [], [], [0]
            for found in shingle_sets(batch.column("text"), words):
                sizes.append(len(found))
                nodes.append(digest(found) if len(found) else None)
                values.append(found[:k])
                edges.append(edges[-1] + min(k, len(found)))
            flat = np.concatenate([np.zeros(0, np.int64), *values])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat)),
                ],
                ["doc_id", "n", "digest", "sketch"],
            )

    return run


def _set_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {digest(s): s for s in shingle_sets(batch.column("text"), words)}
            edges = np.cumsum([0, *map(len, sets.values())]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *sets.values()])
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
            nodes = pa.array(list(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([nodes, lists], ["digest", "items"])

    return run


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _sizes_fit(percent: int, x: str = "n", y: str = "m"):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _two_sided(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the columns of both nodes, named a_... and b_..."""
    for side in "ab":
        own = nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def _estimated(pairs: DataFrame, sketches: DataFrame, k: int, least: int) -> DataFrame:
    """Pairs for which the sketch of the union leaves the similarity possible."""
    both = _two_sided(pairs, sketches, ["sketch"])
    union = F.slice(F.array_sort(F.array_union("a_sketch", "b_sketch")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("a_sketch", "b_sketch")))
    return both.where(shared * k >= F.size(union) * least).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = _two_sided(pairs, sets, ["items"])
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    union = F.size("a_items") + F.size("b_items") - shared
    return both.where(shared * 100 >= union * percent).select("a", "b").distinct()


def _rarest(entries: DataFrame) -> DataFrame:
    """Inverted lists of the rarest values of each node.

    `entries` has a row per value with the node's number of values (`size`) and
    how many of them a partner must share (`need`). Two nodes that do share so
    many have one among their `size - need + 1` rarest in common. In the lists,
    `rest` is how many values of the node do not come before this one: if it is
    the first one that two nodes share, they share no more than that.
    """
    held = entries.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    shared = entries.join(held, "value")
    own = Window.partitionBy("node")
    # Values of the node alone come first in the order; they have no list.
    alone = F.col("size") - F.count(F.lit(1)).over(own)
    lists = (
        shared.withColumn("room", F.col("size") - F.col("need") + 1 - alone)
        .withColumn("central", F.sum("held").over(own))
        .withColumn("place", F.row_number().over(own.orderBy("held", "value")))
        .withColumn("rest", F.col("size") - alone - F.col("place") + 1)
        .where(F.col("place") <= F.col("room"))
        .drop("size", "held", "room", "place")
    )
    length = lists.groupBy("value").agg(F.count(F.lit(1)).alias("length"))
    return checkpointed(lists.join(length.where(F.col("length") > 1), "value").drop("length"))


def _cross_pairs(lists: DataFrame, nodes: DataFrame, kind: str, percent: int, need) -> DataFrame:
    """Pairs of a list that differ in `kind` and are in different components; some repeat.

    Only members outside the most frequent kind of their list are paired with
    its members, so a list of one kind gives nothing. `need` tells how many
    values members x and y must share; pairs that cannot, if this list is the
    first that has both, are left out.
    """
    members = lists.join(nodes.select("node", "part", F.col(kind).alias("kind")), "node")
    counts = members.groupBy("value", "kind").agg(F.count(F.lit(1)).alias("c"))
    tops = counts.groupBy("value").agg(
        F.max(F.struct("c", "kind")).alias("top"), F.count(F.lit(1)).alias("kinds")
    )
    members = members.join(tops.where(F.col("kinds") > 1), "value")
    few = members.where(F.col("kind") != F.col("top.kind"))
    few = few.select("value", F.struct(*[c for c in few.columns if c != "value"]).alias("b"))
    paired = members.alias("a").join(few, "value")
    differ = (F.col("a.part") != F.col("b.part")) & (F.col("a.kind") != F.col("b.kind"))
    enough = F.least("a.rest", "b.rest") >= need
    paired = paired.where(differ & enough & _sizes_fit(percent, "a.n", "b.n"))
    return _ordered(paired.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")))


def _slack(n: str, d: str, percent: int):
    """What the difference `d` to the home leaves of the difference that a link allows.

    Sets of n and m values are linked if (100 + percent) * (values of one of them
    only) <= (100 - percent) * (n + m). With c values that their differences
    share this says: slack + other slack + 2 * (100 + percent) * c >= 0.
    """
    return (100 - percent) * F.col(n) - (100 + percent) * F.col(d)


def _roomy_pairs(relative: DataFrame) -> DataFrame:
    """Each node with the node of its home that has most slack, if that makes a link.

    Two nodes that are linked although their differences share nothing are both
    linked with that one, as it has at least the slack of either.
    """
    own = F.max(F.struct("slack", "node")).alias("own")
    homes = relative.groupBy("home", "home_slack").agg(own)
    roomy = F.greatest(F.col("own"), F.struct(F.col("home_slack").alias("slack"), F.col("home").alias("node")))
    homes = homes.select("home", roomy.alias("most"))
    pairs = relative.join(homes, "home").where(F.col("slack") + F.col("most.slack") >= 0)
    pairs = pairs.select(F.col("node").alias("x"), F.col("most.node").alias("y"))
    return _ordered(pairs.where(F.col("x") != F.col("y")))


def _difference_lists(relative: DataFrame, percent: int) -> DataFrame:
    """Inverted lists, per home, of the rarest values of each node's difference."""
    homes = relative.groupBy("home").agg(F.max(F.greatest("slack", "home_slack")).alias("most"))
    step, size = 2 * (100 + percent), F.col("d")
    by_slack = F.ceil(-(F.col("slack") + F.col("most")) / step)
    # A partner of at most so many values can only be so far from the home.
    largest = F.col("n") + F.floor(F.col("n") * 100 / percent)
    by_size = size - F.floor(largest * (100 - percent) / (100 + percent))
    need = F.greatest(F.lit(1), by_slack, by_size)
    entries = relative.join(homes, "home").withColumn("need", need).where(F.col("need") <= size)
    return _rarest(
        entries.select(
            "node", "n", "slack", size.alias("size"), "need",
            F.explode(F.transform("diff", lambda v: F.xxhash64("home", v))).alias("value"),
        )
    )


def linked_nodes(sketches: DataFrame, sets_of, percent: int, k: int) -> DataFrame | None:
    """(node, component) of every node that meets another; None if no list has two."""
    least = least_overlap(k, percent)
    size = F.size("sketch")
    need = F.greatest(F.lit(1), F.floor(size * least / k))
    lists = _rarest(
        sketches.select("node", "n", size.alias("size"), need.alias("need"), F.explode("sketch").alias("value"))
    )
    active = sketches.join(lists.select("node").distinct(), "node", "left_semi")
    active = checkpointed(active.select("node", "digest", "doc_id", "n", "sketch"))
    free_finished(active.sparkSession)
    if active.isEmpty():
        return None
    sets = checkpointed(sets_of(active))
    free_finished(sets.sparkSession)

    pivots = lists.groupBy("value").agg(F.max(F.struct("central", "node", "n")).alias("best"))
    hubs = pivots.select("value", F.col("best.node").alias("y"), F.col("best.n").alias("m"))
    met = lists.select("value", F.col("node").alias("x"), "n").join(hubs, "value")
    # How often each node meets each pivot.
    met = checkpointed(met.groupBy("x", "n", "y", "m").agg(F.count(F.lit(1)).alias("times")))
    tested = _ordered(met.where((F.col("x") != F.col("y")) & _sizes_fit(percent)))
    tested = checkpointed(tested.distinct())
    links = checkpointed(_confirmed(_estimated(tested, active, k, least), sets, percent))
    free_finished(links.sparkSession)

    homes = met.groupBy(F.col("x").alias("node")).agg(F.max(F.struct("times", "y")).alias("most"))
    homes = homes.select("node", F.col("most.y").alias("home"))
    nodes = checkpointed(
        active.select("node", "n")
        .join(homes, "node")
        .join(components(links), "node", "left")
        .select("node", "n", "home", F.coalesce("component", "node").alias("part"))
    )
    apart = _cross_pairs(lists, nodes, "home", percent, F.least("a.need", "b.need"))

    # Of each node its difference from its home, unless all of the home is one component.
    open_homes = nodes.groupBy("home").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    open_homes = open_homes.where(F.col("p") != F.col("q")).select("home")
    difference = F.concat(F.array_except("items", "base"), F.array_except("base", "items"))
    relative = (
        nodes.where(F.col("node") != F.col("home"))
        .join(open_homes, "home")
        .join(sets, "node")
        .join(sets.select(F.col("node").alias("home"), F.col("items").alias("base")), "home")
        .select("node", "n", "home", F.size("base").cast("long").alias("m"), difference.alias("diff"))
        .withColumn("d", F.size("diff").cast("long"))
        .withColumn("slack", _slack("n", "d", percent))
        .withColumn("home_slack", (100 - percent) * F.col("m"))
    )
    relative = checkpointed(relative)
    free_finished(relative.sparkSession)
    lists = _difference_lists(relative, percent)
    free_finished(lists.sparkSession)
    shared = F.ceil(-(F.col("a.slack") + F.col("b.slack")) / (2 * (100 + percent)))
    outside = _cross_pairs(lists, nodes, "part", percent, shared)

    more = apart.unionByName(outside).unionByName(_roomy_pairs(relative)).distinct()
    more = checkpointed(more.join(tested, ["a", "b"], "left_anti"))
    free_finished(more.sparkSession)
    found = _confirmed(_estimated(more, active, k, least), sets, percent)
    # What was found joins components that are known, so only these are gone through again.
    parts = nodes.select("node", "part")
    for side in "ab":
        own = parts.select(F.col("node").alias(side), F.col("part").alias(f"{side}_part"))
        found = found.join(own, side)
    whole = components(found, "a_part", "b_part")
    whole = whole.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    return parts.join(whole, "part", "left").select(
        "node", F.coalesce("whole", "part").alias("component")
    )


def near_duplicates(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT, k: int = SKETCH
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of `documents`.

    Two documents are linked if 100 * intersection >= percent * union of their
    sets of word shingles, compared in full. `component_id` is the smallest
    doc_id that links lead to, its own included; `kept` marks the document with
    that id. Other columns than doc_id and text are ignored.

    A null, empty or blank text has no shingles and no links. Rows that repeat
    a doc_id with one text have equal results; with other texts each row is a
    document of its own. A row without doc_id cannot be named: it has no
    component and is kept. Very long texts are taken whole.
    """
    rows = documents.select("doc_id", "text")
    schema = "doc_id long, n long, digest binary, sketch array<long>"
    ids = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = checkpointed(
        ids.mapInArrow(_sketch_batches(words, k), schema).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    named = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    # Documents with one set are one node, which has the number of its first row.
    groups = checkpointed(
        sketched.where(named)
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "row")).alias("first"))
        .select("digest", F.col("first.row").alias("node"), F.col("first.doc_id").alias("label"))
    )
    sketches = checkpointed(
        sketched.join(groups.select(F.col("node").alias("row")), "row", "left_semi").select(
            F.col("row").alias("node"), "digest", "doc_id", "n", "sketch"
        )
    )

    def sets_of(active: DataFrame) -> DataFrame:
        """(node, items): the full sets, computed anew from the texts of these nodes only."""
        wanted = active.select("doc_id")
        if wanted.count() <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        texts = ids.join(wanted, "doc_id", "left_semi").select("text")
        sets = texts.mapInArrow(_set_batches(words), "digest binary, items array<long>")
        # Rows that repeat a document give its set again.
        sets = sets.dropDuplicates(["digest"])
        return sets.join(active.select("digest", "node"), "digest").select("node", "items")

    linked = linked_nodes(sketches, sets_of, percent, k)
    labels = groups.select("digest", "node", "label")
    if linked is not None:
        least = (
            linked.join(groups.select("node", "label"), "node")
            .groupBy("component")
            .agg(F.min("label").alias("least"))
        )
        least = linked.join(least, "component").select("node", "least")
        labels = labels.join(least, "node", "left").select(
            "digest", F.coalesce("least", "label").alias("label")
        )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return (
        sketched.select("doc_id", F.col("n").alias("n_shingles"), "digest")
        .join(labels.select("digest", "label"), "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
