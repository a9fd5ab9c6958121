"""One row per key: deduplication, last-write-wins tables, upserts, lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[str | Column]


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_by: Order) -> DataFrame:
    """The first row of each key by ``order_by``; the order should be total.

    Spark turns the ``= 1`` filter into a limit per key that runs before the shuffle as
    well, so a key with a huge share of the rows sends one row per task, not all rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def keyed_table(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Order,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Last write wins: of equal keys keep the row that is last in ``order_by`` columns.

    ``order_by`` lists ascending write order (time, file, line …).
    """
    latest = [c.desc() if isinstance(c, Column) else F.col(c).desc() for c in order_by]
    result = dedupe_by_key(df, keys, latest)
    return result.select(*columns) if columns else result


def cluster_for_lookup(
    df: DataFrame, partition_keys: Sequence[str], clustering: Sequence[str] = ()
) -> DataFrame:
    """Lay rows out by key before a write: files hold key ranges, sorted inside.

    Range partitioning on all the given columns keeps a partition key with very many
    rows from landing in one task; file statistics then prune key lookups.
    """
    order = [*partition_keys, *clustering]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def lookup(df: DataFrame, order_by: Sequence[str] = (), **key: object) -> DataFrame:
    """Rows with the given key values (full key or a prefix), optionally ordered."""
    for column, value in key.items():
        df = df.where(F.col(column) == F.lit(value))
    return df.orderBy(*order_by) if order_by else df


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Order = (),
) -> DataFrame:
    """``target`` with rows of equal key replaced by the last incoming one.

    ``target`` holds one row per key; among incoming rows ``order_by`` is write order.
    The incoming rows are reduced to one per key and the target loses the keys they
    bring, so a small batch is broadcast and a large target is neither sorted nor
    shuffled. NULL keys count as equal.
    """
    columns = target.columns
    latest = keyed_table(incoming, keys, [*order_by, *columns], columns)
    replaced = latest.select(*[F.col(f"`{k}`").alias(f"_new_{k}") for k in keys])
    same_key = reduce(
        Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_new_{k}`")) for k in keys]
    )
    return target.join(replaced, same_key, "left_anti").unionByName(latest)
