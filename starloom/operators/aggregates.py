"""Grouped and global aggregates beyond a plain ``groupBy.agg``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def global_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their row count. NULL keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)).where(F.col(alias) > 1)


def count_elements(
    df: DataFrame, array: str, keys: Sequence[str], element: str, alias: str
) -> DataFrame:
    """Rows per (keys, array element); NULL and empty arrays drop out."""
    return (
        df.select(*keys, F.explode(array).alias(element))
        .groupBy(*keys, element)
        .agg(F.count(F.lit(1)).alias(alias))
    )


def collect_distinct_elements(
    df: DataFrame,
    keys: Sequence[str],
    arrays: Mapping[str, str],
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group: the sorted distinct non-NULL elements of each array, plus summed measures.

    ``arrays`` maps output name → input array column, ``measures`` maps output name → a
    numeric expression that is summed (use ``F.lit(1)`` for a row count).

    One scan serves all arrays and measures, see :func:`element_partials`.
    """
    measures = dict(measures or {})
    return lists_of_partials(element_partials(df, keys, arrays, measures), keys, arrays, measures)


def element_partials(
    df: DataFrame, keys: Sequence[str], arrays: Mapping[str, str], measures: Mapping[str, Column]
) -> DataFrame:
    """One row per group and distinct element, tagged with its array, and one that has the sums.

    The elements of all arrays are exploded into one column, and one more row per input row
    carries the measures. A hash aggregate reduces them to distinct elements per group, so
    what a group gathers is bounded by the vocabulary that ends up in its result.
    Partials of several inputs can be put together: sums add up, elements stay distinct.
    """

    def tagged(column: str, tag: int) -> Column:
        present = F.coalesce(F.col(column), F.array().cast("array<string>"))
        return F.transform(present, lambda e: F.struct(F.lit(tag).alias("tag"), e.alias("element")))

    parts = [tagged(column, tag) for tag, column in enumerate(arrays.values())]
    carrier = F.array(F.struct(F.lit(-1).alias("tag"), F.lit(None).cast("string").alias("element")))
    items = df.select(
        *keys,
        *[expression.alias(f"_m_{name}") for name, expression in measures.items()],
        F.explode(F.concat(carrier, *parts)).alias("_item"),
    )
    return (
        items.where((F.col("_item.tag") < 0) | F.col("_item.element").isNotNull())
        .groupBy(*keys, F.col("_item.tag").alias("_tag"), F.col("_item.element").alias("_element"))
        .agg(*[F.sum(F.when(F.col("_item.tag") < 0, F.col(f"_m_{name}"))).alias(f"_s_{name}") for name in measures],
             F.count(F.lit(1)).alias("_n"))
    )


def lists_of_partials(
    partials: DataFrame, keys: Sequence[str], arrays: Sequence[str] | Mapping[str, str], measures: Sequence[str] | Mapping[str, Column]
) -> DataFrame:
    """Sums and sorted lists per group, from partials that hold each element of a group once."""
    return partials.groupBy(*keys).agg(
        *[F.sum(f"_s_{name}").alias(name) for name in measures],
        *[
            F.sort_array(F.collect_list(F.when(F.col("_tag") == tag, F.col("_element")))).alias(name)
            for tag, name in enumerate(arrays)
        ],
    )
