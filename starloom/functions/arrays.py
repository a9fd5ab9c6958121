"""Label arrays built from sibling columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_distinct(column: Column) -> Column:
    """Drop NULL elements and repeats."""
    return F.array_distinct(F.array_compact(column))


def label_array(columns: Sequence[str], upper: bool = True) -> Column:
    """One array of distinct labels from several columns, upper-cased by default."""
    parts = [F.col(f"`{c}`") for c in columns]
    return compact_distinct(F.array(*[F.upper(p) if upper else p for p in parts]))


def flag_labels(labels: Mapping[str, Column]) -> Column:
    """Array of those labels whose condition holds."""
    return compact_distinct(F.array(*[F.when(cond, label) for label, cond in labels.items()]))
