"""Numeric surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.operators.sinks import append_table
from starloom.session import shared_dir

# fixed value: monotonically_increasing_id counts rows in its lower 33 bits
_ROW_BITS = (1 << 33) - 1


def row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique 64-bit id without a shuffle; neither dense nor stable across runs."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dense_id(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "id", start: int = 0
) -> DataFrame:
    """Consecutive ids in ``order_by`` order; the order should be total.

    The rows are range partitioned and sorted, then written to the checkpoint folder so
    that no later failure can move a row to another partition. An id is the number of
    rows in earlier partitions plus the position in its own. Only one count per
    partition is ever gathered, so no task sees more than its own range.
    """
    shared_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).checkpoint()
    placed = ordered.select("*", F.monotonically_increasing_id().alias("_place")).withColumns(
        {"_part": F.shiftright("_place", 33).cast("int"), "_row": F.col("_place").bitwiseAND(_ROW_BITS)}
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # one row per partition of `ordered`: bounded by spark.sql.shuffle.partitions
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + F.lit(start))
        .drop("_place", "_part", "_row", "_offset")
    )


_MARK = "starloom.identity"


def next_identity(spark: SparkSession, table: str, name: str, start: int = 0) -> int:
    """First identity that the table has not given yet, from its high-water mark.

    A table without a mark, such as one filled by other means, is read once for its largest id.
    """
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    mark = properties.get(f"{_MARK}.{name}")
    if mark is not None:
        return int(mark)
    largest = spark.table(table).agg(F.max(f"`{name}`")).first()[0]
    return start if largest is None else largest + 1


def append_with_identity(
    df: DataFrame, table: str, name: str, order_by: Sequence[str | Column], start: int = 0
) -> tuple[int, int]:
    """Append rows whose ids go on where the last load ended; returns the ids given, as [first, end).

    Ids are consecutive in ``order_by`` order over each load and over all loads. The range
    is reserved in the table's properties before rows are written: a load that dies
    after that leaves a gap, never an id given twice. One load at a time.
    """
    spark = df.sparkSession
    first = next_identity(spark, table, name, start)
    numbered = dense_id(df.drop(name), order_by, name, first)
    end = first + numbered.count()
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_MARK}.{name}' = '{end}')")
    append_table(numbered, table)
    return first, end
