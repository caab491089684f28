"""The rows that each of the three steps loads.

`roots`, `missing_parents` and `children` state one step each. `label_rows`
gives the same three sets from one pass over the narrow columns of the source;
a load uses it, and then reads the payload once for all steps.

Targets are passed as frames with at least the id column.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovelift.operators.bloom import maybe_in
from grovelift.operators.scope import in_scope, without_excluded
from grovelift.operators.sizing import (
    BROADCAST_LIMIT_BYTES,
    Size,
    broadcast_if_small,
    checkpointed,
    checkpointed_with_size,
    join_by_keys,
)
from grovelift.schemas import (
    CHILDREN,
    FILE,
    FILE_COLUMNS,
    ID,
    MISSING_PARENTS,
    PARENT,
    PATH,
    ROOTS,
    STEPS,
)


def _absent(rows: DataFrame, target: DataFrame) -> DataFrame:
    return rows.join(target.select(ID), ID, "left_anti")


def roots(
    source: DataFrame, scope: DataFrame, target: DataFrame, excluded_id: str | None = None
) -> DataFrame:
    """In-scope rows without a parent that the target lacks."""
    rows = source.where(F.col(PARENT).isNull())
    return _absent(in_scope(rows, scope, excluded_id), target)


def children(
    source: DataFrame, scope: DataFrame, target: DataFrame, excluded_id: str | None = None
) -> DataFrame:
    """In-scope rows with a parent that the target lacks."""
    rows = source.where(F.col(PARENT).isNotNull())
    return _absent(in_scope(rows, scope, excluded_id), target)


def _parents_of(source: DataFrame, scoped: DataFrame) -> DataFrame:
    """Source rows whose path is named as parent by one of the given rows.

    Parent paths are made distinct first: a path that very many children share
    is combined before the shuffle. They are then written once, so that their
    size is known. Few paths are broadcast and the source is not shuffled. Many
    paths are a plain shuffle input, where AQE may split a partition of source
    rows with one path; below an aggregate it would not. A Bloom filter of them
    is broadcast first, so that hardly any other source rows are shuffled.
    """
    paths = scoped.where(F.col(PARENT).isNotNull()).select(F.col(PARENT).alias(PATH)).distinct()
    paths, size = checkpointed_with_size(paths, PATH)
    if size.bytes > BROADCAST_LIMIT_BYTES:
        source = maybe_in(source, paths, PATH, size.rows)
    return source.join(broadcast_if_small(paths, size), PATH, "left_semi")


def direct_parents(
    source: DataFrame, scope: DataFrame, excluded_id: str | None = None
) -> DataFrame:
    """Ids of the direct parents of in-scope children, one level up only.

    Children count whether or not the target has them, and the parents
    themselves need not be in scope.
    """
    scoped = in_scope(source.select(ID, PARENT), scope, excluded_id)
    return _parents_of(source.select(ID, PATH), scoped).select(ID).distinct()


def missing_parents(
    source: DataFrame, scope: DataFrame, target: DataFrame, excluded_id: str | None = None
) -> DataFrame:
    """Ids of direct parents that the target lacks; the excluded id is not one."""
    found = without_excluded(direct_parents(source, scope, excluded_id), excluded_id)
    return _absent(found, target)


def label_rows(
    source: DataFrame,
    scope: DataFrame,
    target: DataFrame,
    excluded_id: str | None = None,
    steps: Iterable[int] = STEPS,
    queued: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """(id, step) of every row that the given steps would load, in one pass.

    Running the steps in order means that a row goes to the first step that
    takes it: an in-scope root to step 1 even if a child needs it, an in-scope
    row with a parent to step 2 if a child needs it. So each row may be named
    by several steps and keeps the lowest one.

    With `queued`, step 2 takes the ids in that frame instead of looking for
    parents again. If the source names the file of each row, so does the result;
    of an id in several files `split` is true. With `buckets`, the ids are dealt
    out as a target that is bucketed by id is, which then stays where it is.
    """
    steps = set(steps)
    file = [FILE] if FILE in source.columns else []
    look_for_parents = MISSING_PARENTS in steps and queued is None
    parts = []
    if look_for_parents or steps - {MISSING_PARENTS}:
        rows = source.select(ID, PARENT, *file)
        if ROOTS not in steps:
            rows = rows.where(F.col(PARENT).isNotNull())
        elif not look_for_parents and CHILDREN not in steps:
            rows = rows.where(F.col(PARENT).isNull())
        scoped = in_scope(rows, scope, excluded_id)
        if look_for_parents:  # read by two branches, so written once
            scoped = checkpointed(scoped)
        own = F.when(F.col(PARENT).isNull(), ROOTS).otherwise(CHILDREN).alias("step")
        parts.append(scoped.select(ID, own, *file).where(F.col("step").isin(*steps)))
    if MISSING_PARENTS in steps:
        if look_for_parents:
            queued = without_excluded(source.select(ID, PATH, *file), excluded_id)
            queued = _parents_of(queued, scoped)
        elif file:
            queued = queued.withColumn(FILE, F.lit(None).cast("string"))
        parts.append(queued.select(ID, F.lit(MISSING_PARENTS).alias("step"), *file))
    # The exchange on the id serves this aggregate and the anti join after it.
    rows = reduce(DataFrame.unionByName, parts)
    if buckets:
        rows = rows.repartition(buckets, ID)
    split = F.min(FILE) < F.max(FILE) if file else None
    rows = rows.groupBy(ID).agg(
        F.min("step").cast("short").alias("step"),
        *[F.max(c).alias(c) for c in file],
        *([F.coalesce(split, F.lit(False)).alias("split")] if file else []),
    )
    return _absent(rows, target)


def fetch_rows(
    source: DataFrame, keys: DataFrame, size: Size | None = None, even_out: bool = True
) -> DataFrame:
    """The 14 copied columns of the rows named by `keys`, plus the other key columns.

    This is the only place that touches the payload. Rows found by few keys
    (`size` is their measured size) are evened out after the join, if they come
    from many source files; else `even_out` can be left out, and no payload moves.
    """
    extra = [c for c in keys.columns if c != ID]
    rows = join_by_keys(source.select(*FILE_COLUMNS), keys, ID, size)
    rows = rows.select(*FILE_COLUMNS, *extra)
    few = size is not None and size.bytes <= BROADCAST_LIMIT_BYTES
    return rows.hint("rebalance") if few and even_out else rows
