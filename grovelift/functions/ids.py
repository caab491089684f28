"""Identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a GUID, with or without braces.
GUID = r"^(\{[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\}|[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})$"


def canonical_id(column: str | Column) -> Column:
    """Give a GUID one spelling: upper case, without braces.

    GUIDs are equal by value whatever their case, while Spark compares strings
    byte by byte. Values that do not have the form of a GUID stay unchanged.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value.rlike(GUID), F.upper(F.translate(value, "{}", ""))).otherwise(value)


def canonical_value(value: str | None) -> str | None:
    """The same for one id."""
    if value is None or not re.fullmatch(GUID, value):
        return value
    return value.strip("{}").upper()
