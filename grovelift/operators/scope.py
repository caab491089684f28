"""Which rows are in scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovelift.operators.sizing import broadcast_if_small, measured
from grovelift.schemas import ALLOWED_OWNER, ID, OWNER


def without_excluded(df: DataFrame, excluded_id: str | None) -> DataFrame:
    """Rows with an id other than the excluded one; None excludes nothing."""
    if excluded_id is None:
        return df.where(F.col(ID).isNotNull())
    return df.where(F.col(ID) != F.lit(excluded_id))


def scope_ids(metadata: DataFrame, allowed: DataFrame, id_column: str) -> DataFrame:
    """Ids whose metadata row has an owner on the allow-list, each once.

    The allow-list is joined first because it shrinks the key set. It is made
    distinct and measured: a small one is broadcast, so metadata is not shuffled
    by owner; a large one is shuffled, where AQE can split a large owner.
    The final `distinct` combines map-side, so an id with very many metadata
    rows reaches the shuffle as a few rows, and its exchange serves the join on
    the id that follows.
    """
    owners = allowed.select(F.col(ALLOWED_OWNER).alias(OWNER)).distinct()
    owners = broadcast_if_small(owners, measured(owners, F.col(OWNER).cast("string")))
    return (
        metadata.select(F.col(id_column).alias(ID), OWNER)
        .where(F.col(ID).isNotNull())
        .join(owners, OWNER, "left_semi")
        .select(ID)
        .distinct()
    )


def in_scope(source: DataFrame, scope: DataFrame, excluded_id: str | None = None) -> DataFrame:
    """Source rows in scope. A semi join: metadata adds no column and no copies."""
    return without_excluded(source, excluded_id).join(scope, ID, "left_semi")
