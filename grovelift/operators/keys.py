"""Key rules that the tables rely on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows.

    Counts combine map-side, so a key with very many rows costs no more than
    another.
    """
    keys = list(keys)
    has_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | has_null)
    )


def require_key(df: DataFrame, keys: Iterable[str], what: str) -> DataFrame:
    """Return `df`, or raise if its key is not unique or not complete."""
    keys = list(keys)
    found = key_violations(df, keys).head(1)
    if found:
        raise ValueError(f"{what}: key ({', '.join(keys)}) is violated, e.g. by {found[0]}")
    return df
