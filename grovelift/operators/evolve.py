"""Adding columns to tables that already hold rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_column(
    df: DataFrame, name: str, data_type: T.DataType | str, default: Any = None
) -> DataFrame:
    """Add a column unless it is there; rows already held get the default.

    Without a default the column is NULL for them.
    """
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(data_type))
