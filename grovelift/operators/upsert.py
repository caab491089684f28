"""Insert-or-update of keyed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    update_cols: Iterable[str],
    defaults: Mapping[str, Column] | None = None,
    on_update: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The target after `source` was merged into it by key.

    Matched rows take `update_cols` from the source, NULLs included, and the
    `on_update` values; their other columns stay. New rows take the source's
    columns, and `defaults` where the source has no such column or a NULL in
    it. Keys must be unique and not NULL on both sides (see `require_key`).
    """
    keys, update_cols = list(keys), set(update_cols)
    defaults, on_update = dict(defaults or {}), dict(on_update or {})
    held = target.withColumn("_held", F.lit(True)).alias("t")
    given = source.withColumn("_given", F.lit(True)).alias("s")
    matched = F.col("_held") & F.col("_given")

    def inserted(name: str) -> Column:
        values = [F.col(f"s.`{name}`")] if name in source.columns else []
        values += [defaults[name]] if name in defaults else []
        return F.coalesce(*values) if values else F.lit(None)

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        kept = F.col(f"t.`{name}`")
        if name in update_cols:
            kept = F.when(matched, F.col(f"s.`{name}`")).otherwise(kept)
        elif name in on_update:
            kept = F.when(matched, on_update[name]).otherwise(kept)
        return F.when(F.col("_held"), kept).otherwise(inserted(name))

    columns = [merged(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    return held.join(given, keys, "full_outer").select(*columns)
