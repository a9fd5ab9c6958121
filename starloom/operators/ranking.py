"""Top-N reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, group: Sequence[str], measure: str, n: int, rank_as: str = "rank"
) -> DataFrame:
    """Rows ranked at most ``n`` by descending ``measure`` within each group.

    Ties share a rank and leave gaps, so a group may return more than ``n`` rows. The
    filter on the rank also limits each group before the shuffle.
    """
    window = Window.partitionBy(*group).orderBy(F.col(measure).desc())
    return df.withColumn(rank_as, F.rank().over(window)).where(F.col(rank_as) <= n)


def top_k(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; equal values are ordered by ``tie_break``."""
    return df.orderBy(F.col(measure).desc(), *tie_break).limit(k)


def preview(df: DataFrame, n: int = 20, width: int = 20) -> DataFrame:
    """The first ``n`` rows as text, each value cut to ``width`` characters; NULL is shown as ``NULL``.

    What a notebook shows of a table: the limit reaches the scan, so only as many partitions
    are read as are needed for ``n`` rows, and only the cut values come to the driver.
    """
    if width < 4:
        raise ValueError("width must be 4 or more")

    def shown(name: str) -> Column:
        text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("NULL"))
        cut = F.concat(F.substring(text, 1, width - 3), F.lit("..."))
        return F.when(F.length(text) > width, cut).otherwise(text).alias(name)

    return df.limit(n).select(*[shown(c) for c in df.columns])
