"""Table names and stored script text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(*parts: str) -> str:
    """`a`.`b`.`c`, safe to put into a SQL text as an identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def qualified_name(*parts: str | Column) -> Column:
    """Three name columns as one dotted name."""
    return F.concat_ws(".", *parts)


def bind_tokens(body: str | Column, values: Mapping[str, Column]) -> Column:
    """Replace each token in a script text by the value of a column.

    The replacement is literal: tokens hold brackets, which a regular
    expression would read as character classes.
    """
    text = F.col(body) if isinstance(body, str) else body
    for token, value in values.items():
        text = F.replace(text, F.lit(token), value.cast("string"))
    return text
