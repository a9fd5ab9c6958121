"""Joins the reference workloads need beyond a plain equi join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLITTABLE = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "left_anti", "leftanti"}


def row_spread(df: DataFrame, buckets: int) -> Column:
    """Bucket number that spreads rows evenly and is the same when a task is repeated.

    It hashes the whole row together with its input partition, so copies of one row
    are spread too, and no random value can move a row after an executor is lost.
    """
    hashable = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(
        F.xxhash64(*[F.col(f"`{c}`") for c in hashable], F.spark_partition_id()), F.lit(buckets)
    ).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Key values of more than ``share`` of the rows, so at most ``1 / share`` of them.

    Lazy: nothing runs before the result is used. Store it to use it for several joins.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    least = df.agg((F.count(F.lit(1)) * share).alias("_least")).scalar()
    return counts.where(F.col("_n") > least).select(*keys)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    salts: int = 64,
) -> DataFrame:
    """Equi join whose ``hot`` left keys are spread over ``salts`` tasks each.

    ``hot`` lists key values, from a stored profile or :func:`hot_keys`; it must be short,
    as it is broadcast. Without it this is the plain join, whose skewed partitions AQE
    splits. With it the left rows of hot keys are spread, the right rows of those keys are
    repeated once per salt, and all other rows are joined as usual. The result equals
    the plain join, NULL keys included. Building the join runs no job.
    """
    on = list(on)
    if how.lower() not in _SPLITTABLE:
        raise ValueError(f"skew_join cannot split the left side of a {how} join")
    if hot is None:
        return left.join(right, on, how)
    listed = F.broadcast(hot.select(*on).dropna().distinct().withColumn("_hot", F.lit(True)))
    any_null = reduce(Column.__or__, [F.col(f"`{key}`").isNull() for key in on])
    # rows with a NULL key match nothing, so they may be spread as well
    salted_left = left.join(listed, on, "left").withColumn(
        "_salt",
        F.when(F.col("_hot").isNotNull() | any_null, row_spread(left, salts)).otherwise(F.lit(0)),
    )
    salted_right = right.join(listed, on, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    return salted_left.drop("_hot").join(salted_right.drop("_hot"), [*on, "_salt"], how).drop("_salt")


def explode_keys(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """One row per distinct non-NULL value among ``keys``, named ``alias``.

    A key equal to an earlier one is blanked with plain comparisons, which stay inside
    generated code; array functions would cost several times as much per row.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    first_seen = [columns[0]]
    for i, column in enumerate(columns[1:], start=1):
        repeated = reduce(Column.__or__, [column.eqNullSafe(c) for c in columns[:i]])
        first_seen.append(F.when(~repeated, column))
    return df.withColumn(alias, F.explode(F.array(*first_seen))).where(F.col(alias).isNotNull())


def any_key_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_key: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``left.k1 = right.key OR left.k2 = right.key OR …``.

    One row per matching pair, also when several left keys are equal. Written as an
    equi join over the distinct keys of each left row, so it hashes on the key where the
    literal OR form compares all pairs. NULL keys match nothing. ``hot`` names key
    values (column ``right_key``) whose left rows are spread, see :func:`skew_join`.
    """
    return skew_join(explode_keys(left, left_keys, right_key), right, [right_key], "inner", hot)


def insert_new(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    null_aware: bool = False,
    target_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Incoming rows whose key is not in ``target`` yet.

    ``null_aware=False`` is a plain anti join: a row with a NULL key is new.
    ``null_aware=True`` (single key) follows SQL ``NOT IN``: with an empty target every
    row is new; with a NULL among the target keys none is; else NULL keys are not new.
    SQL's own form can only run by broadcasting the target; this one joins by key and
    takes the two NULL rules from scalar subqueries, so the target may be any size. The
    target's keys are reduced to distinct ones before the shuffle that the join needs.
    """
    keys = list(keys)
    existing = target.select(
        *[F.col(f"`{t}`").alias(k) for k, t in zip(keys, target_keys or keys, strict=True)]
    ).distinct()
    fresh = incoming.join(existing, keys, "left_anti").select(*incoming.columns)
    if not null_aware:
        return fresh
    if len(keys) != 1:
        raise ValueError("NOT IN semantics are defined for a single key")
    key = F.col(f"`{keys[0]}`")
    return fresh.where(
        ~existing.where(key.isNull()).exists() & (key.isNotNull() | ~existing.exists())
    )
