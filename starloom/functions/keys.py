"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*columns: Column, separator: str = "") -> Column:
    """md5 over the columns' text; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, column in enumerate(columns):
        if i and separator:
            parts.append(F.lit(separator))
        parts.append(column.cast("string"))
    return F.md5(F.concat(*parts))


def row_key(*columns: Column) -> Column:
    """md5 of the columns' names and values, never NULL: NULLs are values of their own."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
