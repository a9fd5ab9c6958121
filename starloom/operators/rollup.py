"""Mergeable roll-ups: stored partial aggregates that batches are added to.

A roll-up keeps partial sums per group, in folders by batch and period (day, month). A
batch is aggregated and its partials are written into a folder of its own, so that a repeated
batch replaces itself and earlier input is never read again. The result of a period
is the sum of its partials; only periods that a batch touches are rebuilt. Lists of
distinct elements are kept as one partial row per element and built on reading.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.aggregates import element_partials, lists_of_partials
from starloom.operators.sinks import write_parquet


@dataclass(frozen=True)
class RollUp:
    """Groups (``keys``), summed measures and collected arrays.

    ``period`` says from the keys which folder (``_period``) a group belongs to.
    """

    keys: Sequence[str]
    period: Column
    measures: Mapping[str, Column]
    arrays: Mapping[str, str] = field(default_factory=dict)

    def partials(self, rows: DataFrame) -> DataFrame:
        if self.arrays:
            return element_partials(rows, self.keys, self.arrays, self.measures)
        return rows.groupBy(*self.keys).agg(*[F.sum(m).alias(f"_s_{name}") for name, m in self.measures.items()])

    def result(self, partials: DataFrame) -> DataFrame:
        """Groups from any number of partials of each."""
        sums = {name: F.sum(f"_s_{name}") for name in self.measures}
        if not self.arrays:
            return partials.groupBy(*self.keys).agg(*[s.alias(name) for name, s in sums.items()])
        merged = partials.groupBy(*self.keys, "_tag", "_element").agg(
            *[s.alias(f"_s_{name}") for name, s in sums.items()], F.sum("_n").alias("_n")
        )
        return lists_of_partials(merged, self.keys, self.arrays, self.measures)


def add_batch(rollup: RollUp, rows: DataFrame, state: str, batch: int) -> list:
    """Store the partials of a batch under ``state``; returns the periods that it touches.

    A batch that is given again, with the same number and rows, replaces itself. The
    driver gets one value per period, of which there are no more than the calendar has.
    """
    path = f"{state}/_batch={batch}"
    # a folder of a batch without rows would have no columns to read
    partials = rollup.partials(rows).withColumn("_period", rollup.period)
    write_parquet(partials, path, ["_period"])
    if partials.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true"
    ).load(path).select("path").isEmpty():
        return []
    found = partials.sparkSession.read.parquet(path).select("_period").distinct().collect()
    return sorted((r[0] for r in found), key=lambda p: (p is not None, p))


def _within(periods: Sequence) -> Column:
    known = [p for p in periods if p is not None]
    tests = ([F.col("_period").isin(known)] if known else []) + ([F.col("_period").isNull()] if None in periods else [])
    return reduce(Column.__or__, tests, F.lit(False))


def rebuild(rollup: RollUp, spark: SparkSession, state: str, target: str, periods: Sequence) -> None:
    """Write the groups of some periods anew from all their partials; other folders stay as they are."""
    if periods:
        partials = spark.read.parquet(state).where(_within(periods))
        columns = [*rollup.keys, *rollup.measures, *rollup.arrays]
        result = rollup.result(partials).select(*columns, rollup.period.alias("_period"))
        write_parquet(result, target, ["_period"], dynamic=True)


def merge_batch(rollup: RollUp, rows: DataFrame, root: str, batch: int) -> list:
    """Add a batch to the state under ``root`` and bring the touched periods of ``root``/table up to date."""
    periods = add_batch(rollup, rows, f"{root}/state", batch)
    rebuild(rollup, rows.sparkSession, f"{root}/state", f"{root}/table", periods)
    return periods


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/table")
