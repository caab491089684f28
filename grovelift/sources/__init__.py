from grovelift.sources.files import TargetTable, read_allowed, read_metadata, read_source
from grovelift.sources.state import StateStore

__all__ = ["StateStore", "TargetTable", "read_allowed", "read_metadata", "read_source"]
