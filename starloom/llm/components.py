"""Connected components by alternating large and small stars, and grouped streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex in edges (a, b); component is the smallest id reachable.

    Each round hangs neighbours on the smallest vertex in sight, so the depth
    falls by half or better; it ends when every vertex hangs on a root. Only
    minima are gathered per vertex, never its neighbours. Rounds are written to
    the shared folder. Self-loops, repeated edges and nulls are ignored.
    """
    a, b = F.col("a"), F.col("b")
    tree = stored(
        edges.filter((a != b) & a.isNotNull() & b.isNotNull())
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("p"))
        .distinct()
    )
    for _ in range(max_rounds):
        if _flat(tree):
            # a vertex that hangs on several roots would not be flat: each has one parent here
            roots = tree.select(F.col("p").alias("id"), F.col("p").alias("component")).distinct()
            return tree.select(F.col("v").alias("id"), F.col("p").alias("component")).unionByName(roots)
        both = tree.unionByName(tree.select(F.col("p").alias("v"), F.col("v").alias("p")))
        lowest = stored(both.groupBy("v").agg(F.min(F.least("v", "p")).alias("m")))
        large = (
            both.join(lowest.withColumnRenamed("v", "k"), F.col("v") == F.col("k"))
            .filter(F.col("p") > F.col("v"))
            .select(F.col("p").alias("v"), F.col("m").alias("p"))
        )
        # roots keep their place: a vertex without larger neighbours hangs on its minimum
        large = stored(
            large.unionByName(lowest.filter("v != m").select("v", F.col("m").alias("p"))).distinct()
        )
        parent = stored(large.groupBy("v").agg(F.min("p").alias("m")))
        moved = (
            large.join(parent.withColumnRenamed("v", "k"), F.col("v") == F.col("k"))
            .filter(F.col("p") != F.col("m"))
            .select(F.col("p").alias("v"), F.col("m").alias("p"))
        )
        tree = stored(moved.unionByName(parent.select("v", F.col("m").alias("p"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _flat(tree: DataFrame) -> bool:
    """Whether every vertex has one parent and no parent hangs on another."""
    seen = tree.select(F.col("v").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        tree.select(F.col("p").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")).distinct()
    )
    held = seen.groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
    return held.filter((F.col("c") > 1) | ((F.col("c") > 0) & (F.col("p") > 0))).isEmpty()


def by_group(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Batches of a sorted partition, cut so that no group is spread over two of them."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if batch.empty:
            continue
        held.append(batch)
        size += len(batch)
        if size < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = frame[keys].iloc[-1]
        same = (frame[keys] == last).all(axis=1).to_numpy()
        cut = len(frame) - int(same[::-1].argmin() if not same.all() else len(frame))
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
        rest = frame.iloc[cut:]
        held, size = ([rest] if len(rest) else []), len(rest)
        if len(rest) >= rows:
            size = 0  # one long group: gather on
    if held:
        yield pd.concat(held, ignore_index=True)
