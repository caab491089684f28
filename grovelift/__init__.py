"""Scoped, resumable loads of parent/child file tables, as Spark jobs."""

from grovelift.plans.config import TableConfig
from grovelift.plans.load import RunResult, run_all, run_table
from grovelift.sources.state import StateStore

__all__ = ["RunResult", "StateStore", "TableConfig", "run_all", "run_table"]
