"""Which tables to load, and from where."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovelift.functions import qualified_name
from grovelift.schemas import CONFIG_UPDATED
from grovelift.sources.state import StateStore


@dataclass(frozen=True)
class TableConfig:
    table_name: str
    source: str
    target: str
    metadata: str
    metadata_id_column: str


def resolved_names(config: DataFrame) -> DataFrame:
    """Config rows with the dotted names of their three tables."""
    names = [
        qualified_name(f"{role}_database", f"{role}_schema", f"{role}_table").alias(role)
        for role in ("source", "target", "metadata")
    ]
    return config.select("table_name", *names, "metadata_id_column", "is_active")


def active(config: DataFrame) -> DataFrame:
    return resolved_names(config.where(F.col("is_active"))).drop("is_active")


def load_active(state: StateStore, table_name: str) -> TableConfig:
    """The config of one table; an error if there is none or it is switched off."""
    row = active(state.read("table_config").where(F.col("table_name") == table_name)).first()
    if row is None:
        raise ValueError(f"table {table_name!r} has no config or is not active")
    return TableConfig(**row.asDict())


def upsert_config(state: StateStore, rows: DataFrame, now: datetime | None = None) -> None:
    """Add tables, or change the names of tables that are there."""
    clock = F.lit(now).cast("timestamp_ntz") if now else F.localtimestamp()
    state.upsert(
        "table_config",
        rows,
        CONFIG_UPDATED,
        defaults={"is_active": F.lit(True), "created_at": clock},
        on_update={"updated_at": clock},
    )
