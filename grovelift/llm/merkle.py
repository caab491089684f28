"""A Merkle manifest of a dataset, with a proof for every row by octopus multiproofs.

Rows are leaves. The leaves of each source, in order of doc_id, form a tree of
runs of three; the roots of the sources form one more such tree, whose root
stands for the whole dataset.

Leaves lie in partitions, blocks of consecutive leaves of one source:

1. Each partition computes the root of its leaves, and which nodes outside it
   the proofs of all its leaves need: per level the runs that it touches, less
   what follows from its own leaves (`missing_nodes`). This is the minimal
   union of their coordinates.
2. The nodes above the blocks are built from block roots in blocks of the same
   size, so a source of any size takes a few rounds, each on a small fraction
   of the rows of the one before.
3. Each partition fetches its missing nodes once, by a join on coordinates,
   derives the interior nodes that its leaves share, and expands them to one
   proof per leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.llm.common import checkpointed, spelled
from grovelift.operators.sizing import broadcast_if_small, measured

RUN = 3
# Levels within a block. A block has RUN ** BLOCK_LEVELS leaves at most, 64 bytes each.
BLOCK_LEVELS = 6
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SLOT_BITS = 33
_SIDES = [T.StructField(side, T.StringType()) for side in ("left", "right")]
_PATH = T.ArrayType(T.StructType(_SIDES))
_COORDINATES = "array<struct<level: int, place: long>>"


# -- digests as columns


def leaf_digest(*values: Column) -> Column:
    """Digest of values of any type as `spelled`: `-` for null, else length in bytes, `:`, value."""
    return F.sha2(spelled(*values).cast("binary"), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof, leaf, lambda own, at: F.sha2(F.concat(at["left"], own, at["right"]).cast("binary"), 256)
    )


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up, left to right."""
    siblings = F.transform(proof, lambda at: F.concat(at["left"], at["right"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


# -- trees, as lists of levels


def _digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def tree_levels(leaves: list[str], height: int | None = None) -> list[list[str]]:
    """All levels above and including these nodes: up to one node, or so many steps."""
    levels = [leaves]
    while len(levels[-1]) > 1 if height is None else len(levels) <= height:
        below = levels[-1]
        levels.append([_digest(below[i : i + RUN]) for i in range(0, len(below), RUN)])
    return levels


def tree_height(n: int) -> int:
    """Steps from n leaves to one node."""
    height = 0
    while n > 1:
        n, height = -(-n // RUN), height + 1
    return height


def missing_nodes(first: int, last: int, n: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that proofs of the leaves `first` to `last` of n need.

    Leaves in the range are known, and so are all nodes that follow from known
    ones; of each run that holds a known node only the others must be fetched.
    """
    needed, level = [], 0
    while n > 1:
        start, stop = first - first % RUN, min(last - last % RUN + RUN, n)
        needed += [(level, p) for p in [*range(start, first), *range(last + 1, stop)]]
        first, last, n, level = first // RUN, last // RUN, -(-n // RUN), level + 1
    return needed


def expand_proofs(
    first: int, leaves: list[str], n: int, fetched: dict[tuple[int, int], str]
) -> tuple[list[list[tuple[str, str]]], str]:
    """The proof of every leaf of a range, as (left, right) siblings per level, and the root.

    `fetched` holds the nodes of `missing_nodes`. Each interior node is derived once.
    """
    start, known, steps = first, dict(enumerate(leaves, first)), []
    level = 0
    while n > 1:
        known |= {place: node for (at, place), node in fetched.items() if at == level}
        above, sides = {}, {}
        for place in sorted(known):
            run = place - place % RUN
            own = [known[p] for p in range(run, min(run + RUN, n))]
            above.setdefault(place // RUN, own)
            sides[place] = ("".join(own[: place - run]), "".join(own[place - run + 1 :]))
        steps.append(sides)
        known = {place: _digest(own) for place, own in above.items()}
        n, level = -(-n // RUN), level + 1
    proofs = [
        [sides[place // RUN**step] for step, sides in enumerate(steps)]
        for place in range(start, start + len(leaves))
    ]
    return proofs, known[0]


# -- trees over frames


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Adds `place`, from 0 by `order` within `tree`, and `n`, the leaves of the tree.

    Rows are range-partitioned and sorted, so that no task needs a whole tree;
    a row number breaks the ties of repeated rows.
    """
    tie = F.monotonically_increasing_id()
    keys = ["tree", *order, "tie"]
    ranged = leaves.withColumn("tie", tie).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = checkpointed(ranged.drop("tie").withColumn("slot", F.monotonically_increasing_id()))
    part = F.shiftright("slot", _SLOT_BITS).alias("part")
    own = F.col("slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    starts = ranged.groupBy("tree", part).agg(F.min(own).alias("low"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("low")
    starts = starts.select("tree", "part", shift.alias("shift"), F.sum("rows").over(tree).alias("n"))
    starts = checkpointed(starts)
    # One row per partition and tree: broadcast if that is little.
    starts = broadcast_if_small(starts, measured(starts, "tree"))
    placed = ranged.withColumn("part", part).join(starts, ["tree", "part"])
    return placed.withColumn("place", own + F.col("shift")).drop("part", "shift", "slot")


def _block(place: str = "place") -> Column:
    return F.floor(F.col(place) / F.lit(RUN**BLOCK_LEVELS)).cast("long")


def _block_roots(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The root of one block, and the nodes that its proofs need from elsewhere."""
    rows = rows.sort_by("place")
    n, first = rows["n"][0].as_py(), rows["place"][0].as_py()
    whole = n <= RUN**BLOCK_LEVELS
    root = tree_levels(rows["leaf"].to_pylist(), None if whole else BLOCK_LEVELS)[-1][0]
    needed = missing_nodes(first, first + rows.num_rows - 1, n)
    needed = [{"level": level, "place": place} for level, place in needed]
    return pa.table(
        {
            "tree": pa.array([key[0].as_py()], pa.string()),
            "block": pa.array([key[1].as_py()], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "node": pa.array([root], pa.string()),
            "needed": pa.array(
                [needed], pa.list_(pa.struct([("level", pa.int32()), ("place", pa.int64())]))
            ),
        }
    )


def _nodes_above(level: int):
    """All nodes up to BLOCK_LEVELS above a block of nodes of one level."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        n, first = rows["n"][0].as_py(), rows["place"][0].as_py()
        height = min(BLOCK_LEVELS, tree_height(n) - level)
        levels = tree_levels(rows["node"].to_pylist(), height)
        out = [
            (level + step, first // RUN**step + i, node)
            for step, nodes in enumerate(levels[1:], 1)
            for i, node in enumerate(nodes)
        ]
        steps, places, nodes = zip(*out, strict=True)
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * len(out), pa.string()),
                "n": pa.array([n] * len(out), pa.int64()),
                "level": pa.array(steps, pa.int32()),
                "place": pa.array(places, pa.int64()),
                "node": pa.array(nodes, pa.string()),
            }
        )

    return run


def _upper_nodes(blocks: DataFrame) -> DataFrame:
    """(tree, n, level, place, node) from the block roots up; of trees of one block, its root."""
    level = F.when(F.col("n") > RUN**BLOCK_LEVELS, BLOCK_LEVELS).otherwise(-1).cast("int")
    nodes = blocks.select("tree", "n", level.alias("level"), F.col("block").alias("place"), "node")
    at, below = BLOCK_LEVELS, nodes.where(F.col("level") == BLOCK_LEVELS)
    most = blocks.agg(F.max("n")).first()[0] or 0
    while tree_height(most) > at:
        above = below.withColumn("block", _block()).groupBy("tree", "block")
        above = checkpointed(
            above.applyInArrow(_nodes_above(at), "tree string, n long, level int, place long, node string")
        )
        nodes, at = nodes.unionByName(above), at + BLOCK_LEVELS
        below = above.where((F.col("level") == at) & (F.col("n") > RUN**at))
    return nodes


def _roots(nodes: DataFrame) -> DataFrame:
    """(tree, root): the nodes without siblings on their level."""
    top = (F.col("level") < 0) | (F.col("n") <= F.pow(F.lit(float(RUN)), F.col("level")))
    return nodes.where(top).select("tree", F.col("node").alias("root"))


def _fetched(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per block its missing nodes, each row of them once."""
    asked = blocks.select("tree", "block", F.explode("needed").alias("at"))
    asked = asked.select("tree", "block", "at.level", "at.place")
    # Nodes near a root are asked for by all blocks of a tree: a plain join,
    # which Spark splits on the side of the questions.
    return asked.join(nodes.drop("n"), ["tree", "level", "place"])


def _expanded(_key, rows: pa.Table, fetched: pa.Table) -> pa.Table:
    """The proofs of one block."""
    rows = rows.sort_by("place")
    columns = (fetched[c].to_pylist() for c in ("level", "place", "node"))
    held = {(level, place): node for level, place, node in zip(*columns, strict=True)}
    n, first = rows["n"][0].as_py(), rows["place"][0].as_py()
    proofs, root = expand_proofs(first, rows["leaf"].to_pylist(), n, held)
    sides = [[{"left": a, "right": b} for a, b in proof] for proof in proofs]
    path = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    out = rows.select(["tree", "place", "leaf", "row"])
    out = out.append_column("root", pa.array([root] * rows.num_rows, pa.string()))
    return out.append_column("path", pa.array(sides, path))


def tree_proofs(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(tree, root) of every tree, and tree, place, leaf, row, root, path of every leaf.

    `leaves` has `tree` string, `leaf` string, `row` of any type, and the
    columns to order by. `path` has, from the leaf up, the siblings to the left
    and right at each level, each side as one text.
    """
    placed = _numbered(leaves, order)
    placed = placed.select("tree", "place", "n", "leaf", "row").withColumn("block", _block())
    schema = f"tree string, block long, n long, node string, needed {_COORDINATES}"
    blocks = placed.select("tree", "block", "place", "n", "leaf")
    blocks = checkpointed(blocks.groupBy("tree", "block").applyInArrow(_block_roots, schema))
    nodes = _upper_nodes(blocks)
    own = placed.groupBy("tree", "block").cogroup(_fetched(blocks, nodes).groupBy("tree", "block"))
    given = [placed.schema[c] for c in ("tree", "place", "leaf", "row")]
    out = T.StructType([*given, T.StructField("root", T.StringType()), T.StructField("path", _PATH)])
    return _roots(nodes), own.applyInArrow(_expanded, out)


def dataset_proofs(
    documents: DataFrame, leaf: Column, source: str = "source", order: str = "doc_id",
    kept: Column | None = None,
) -> DataFrame:
    """row, place, leaf, subroot, root and proof of every row of `documents`.

    `leaf` is the digest of a row as a column, `row` whatever `kept` says (the
    order column by default). A proof has the siblings from the leaf up to the
    root of the dataset, per level those to the left and those to the right.

    Trees are made per value of `source`, a null being a source of its own that
    comes before all others. Within a source rows go by `order`, nulls first,
    then by leaf. Repeated rows are leaves each. Without rows there are none.
    """
    # Private names: an "s" before a name keeps a null apart from an empty name.
    tree = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))
    kept = F.col(order) if kept is None else kept
    rows = documents.select(
        tree.alias("tree"), F.col(order).alias("at"), leaf.alias("leaf"), kept.alias("row")
    )
    roots, leaves = tree_proofs(rows, ["at", "leaf"])
    roots = checkpointed(roots)
    tops = roots.select(
        F.lit("").alias("tree"), F.col("root").alias("leaf"), F.col("tree").alias("row")
    )
    _, above = tree_proofs(tops, ["row"])
    above = checkpointed(
        above.select(F.col("row").alias("tree"), F.col("root").alias("whole"), F.col("path").alias("rest"))
    )
    # A row of some hundred bytes per source.
    above = broadcast_if_small(above, measured(above, F.to_json("rest")))
    return leaves.join(above, "tree").select(
        "row",
        "place",
        "leaf",
        F.col("root").alias("subroot"),
        F.col("whole").alias("root"),
        F.concat("path", "rest").alias("proof"),
    )


def audited_manifest(documents: DataFrame) -> DataFrame:
    """Leaf, roots and proof digest of each document, and an audit of tampered ones.

    Where crc32 of the decimal doc_id is even, the line feeds of the text are
    taken out before the audit; the root is then recomputed from the leaf that
    results and the original siblings. `verified` tells whether it is the root.

    A null in any column is hashed as such and stays as it is; a row without
    doc_id is not tampered with and comes first in its source. Empty and very
    long texts and repeated rows are leaves like others; other columns are
    ignored. Without documents there are no rows.
    """
    given = [F.col(c) for c in LEAF_COLUMNS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    stripped = leaf_digest(*given[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    changed = even & F.contains(F.col("text"), F.lit("\n"))
    # Null where nothing changes, so that most rows carry one digest.
    kept = F.struct("doc_id", F.when(changed, stripped).alias("tampered"))
    proofs = dataset_proofs(documents, leaf_digest(*given), kept=kept)
    found = folded(F.coalesce(F.col("row.tampered"), F.col("leaf")), F.col("proof"))
    return proofs.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        found.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql() -> str:
    """The same manifest and audit in SQL."""

    def digest(text: str) -> str:
        parts = [
            f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
            for c in (*LEAF_COLUMNS[:-1], text)
        ]
        return f"sha256({' || '.join(parts)})"

    crc = """xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT,
                            [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                 lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

    def tree(name: str, leaves: str) -> str:
        return f"""
        {name} AS (
          SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS n
          FROM {leaves}
          UNION ALL
          (SELECT tree, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)),
                  (max(n) + 2) // 3
           FROM {name} WHERE n > 1 GROUP BY tree, level, place // 3)
        ), {name}_paths AS MATERIALIZED (
          SELECT o.tree, o.place AS leaf_place, t.level,
                 coalesce(string_agg(t.node, '' ORDER BY t.place)
                          FILTER (t.place < o.place // (3 ** t.level)::BIGINT), '') AS l,
                 coalesce(string_agg(t.node, '' ORDER BY t.place)
                          FILTER (t.place > o.place // (3 ** t.level)::BIGINT), '') AS r
          FROM {leaves} o JOIN {name} t
            ON t.tree = o.tree AND t.n > 1
           AND t.place // 3 = o.place // (3 ** (t.level + 1))::BIGINT
          GROUP BY ALL
        )"""

    return rf"""
        WITH RECURSIVE docs AS MATERIALIZED (
          SELECT doc_id, coalesce('s' || source, '') AS tree, {digest("text")} AS leaf,
                 CASE WHEN doc_id IS NOT NULL AND ({crc}) % 2 = 0
                      THEN {digest("replace(text, chr(10), '')")}
                      ELSE {digest("text")} END AS tampered
          FROM documents
        ), leaves AS MATERIALIZED (
          SELECT *, row_number() OVER (
            PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
          FROM docs
        ), {tree("nodes", "leaves")},
        subroots AS MATERIALIZED (SELECT tree, node FROM nodes WHERE n = 1),
        sources AS MATERIALIZED (
          SELECT '' AS tree, tree AS own, node AS leaf,
                 row_number() OVER (ORDER BY tree) - 1 AS place
          FROM subroots
        ), {tree("tops", "sources")},
        steps AS (
          SELECT tree, leaf_place, level, l, r FROM nodes_paths
          UNION ALL
          SELECT o.tree, o.place, 1000 + t.level, t.l, t.r
          FROM leaves o JOIN sources s ON s.own = o.tree
          JOIN tops_paths t ON t.leaf_place = s.place
        ), proofs AS MATERIALIZED (
          SELECT tree, leaf_place, string_agg(l || r, '' ORDER BY level) AS siblings,
                 list(l || '|' || r ORDER BY level) AS path
          FROM steps GROUP BY ALL
        ), found AS (
          SELECT o.doc_id, o.leaf, s.leaf AS subroot,
                 (SELECT node FROM tops WHERE n = 1) AS root,
                 sha256(coalesce(siblings, '')) AS proof_sha256,
                 list_reduce(list_prepend(tampered, coalesce(path, [])),
                   lambda own, x: sha256(split_part(x, '|', 1) || own || split_part(x, '|', 2)))
                   AS folded_root
          FROM leaves o JOIN sources s ON s.own = o.tree
          LEFT JOIN proofs p ON p.tree = o.tree AND p.leaf_place = o.place
        )
        SELECT *, folded_root = root AS verified FROM found
    """
