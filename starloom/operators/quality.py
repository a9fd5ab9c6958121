"""Data-quality operators: each table is scanned once for all checks on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """A quality check failed; the message lists the failed checks."""


REPORT_COLUMNS = ["table_name", "check_name", "column_name", "row_count", "failed_count", "passed"]


@dataclass(frozen=True)
class CheckSpec:
    """Checks on one table: not empty unless said otherwise, plus those named here."""

    table_name: str
    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    references: Sequence[tuple[str, str, str]] = field(default_factory=tuple)
    """(column, parent table, parent column)"""
    may_be_empty: bool = False


def _report(df: DataFrame, table: str, checks: Sequence[tuple[str, str, Column, Column]]) -> DataFrame:
    """One row of counts → one report row per (check, column, failed count, passed)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.lit(column).alias("column_name"),
                F.col("_rows").alias("row_count"),
                failed.cast("bigint").alias("failed_count"),
                passed.alias("passed"),
            )
            for check, column, failed, passed in checks
        ]
    )
    return df.select(F.inline(rows))


def check_columns(df: DataFrame, table: str, not_null: Sequence[str] = ()) -> DataFrame:
    """Not-empty check plus a not-NULL check per column, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)],
    )
    checks = [("not_empty", "", F.lit(0), F.col("_rows") > 0)]
    for i, c in enumerate(not_null):
        checks.append(("not_null", c, F.col(f"_null_{i}"), F.col(f"_null_{i}") == 0))
    return _report(counts, table, checks)


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    return check_columns(df, table)


def check_not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    return check_columns(df, table, [column]).where(F.col("check_name") == "not_null")


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """``failed_count`` is the number of key values that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.count_if(F.col("_n") > 1).alias("_failed"),
    )
    return _report(
        counts, table, [("unique", ",".join(keys), F.col("_failed"), F.col("_failed") == 0)]
    )


def check_references(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """``failed_count`` is the number of rows whose non-NULL value has no parent row.

    Values are counted first, so the join sees one row per value even when a few values
    hold most rows.
    """
    values = df.groupBy(F.col(f"`{column}`").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(F.col(f"`{parent_column}`").alias("_value")).distinct()
    counts = (
        values.join(parents.withColumn("_known", F.lit(True)), "_value", "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
            F.coalesce(
                F.sum(F.when(F.col("_value").isNotNull() & F.col("_known").isNull(), F.col("_n"))),
                F.lit(0),
            ).alias("_failed"),
        )
    )
    return _report(counts, table, [("references", column, F.col("_failed"), F.col("_failed") == 0)])


def _text_of(column: Column) -> Column:
    return column.cast("string")


def check_table(df: DataFrame, spec: CheckSpec, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All checks of ``spec`` on ``df`` in one scan of it and one of each parent.

    Every row gives one entry per unique key and reference, tagged with its check, and
    one that carries the NULL flags. A first aggregate counts equal entries, already before
    the shuffle, so neither a hot key nor the carriers travel row by row; a second one
    counts what failed. Parent values join in as entries without rows. ``parents`` gives
    parent tables that are not, or not yet, in the catalog.
    """
    spark = df.sparkSession
    parents = parents or {}

    def entry(tag: int, parts: Sequence[Column]) -> Column:
        return F.struct(F.lit(tag).alias("tag"), F.array(*parts).cast("array<string>").alias("value"))

    first_reference = 1 + len(spec.unique)
    entries = [entry(0, [])]
    entries += [entry(i, [_text_of(F.col(f"`{k}`")) for k in keys]) for i, keys in enumerate(spec.unique, start=1)]
    known = []
    for tag, (column, parent, parent_column) in enumerate(spec.references, start=first_reference):
        values = (parents[parent] if parent in parents else spark.table(parent)).select(
            F.col(f"`{parent_column}`").alias("v")
        )
        # both sides as text of one type, as a join would compare them
        kind = df.select(F.col(f"`{column}`").alias("v")).limit(0).union(values.limit(0)).schema["v"].dataType
        entries.append(entry(tag, [_text_of(F.col(f"`{column}`").cast(kind))]))
        known.append(values.where(F.col("v").isNotNull()).select(entry(tag, [_text_of(F.col("v").cast(kind))]).alias("e")))
    nulls = [f"_null_{i}" for i in range(len(spec.not_null))]
    rows = df.select(
        *[F.col(f"`{c}`").isNull().alias(n) for c, n in zip(spec.not_null, nulls, strict=True)],
        F.explode(F.array(*entries)).alias("e"),
    ).select("e.*", F.lit(1).cast("long").alias("n"), F.lit(False).alias("known"), *nulls)
    for values in known:
        rows = rows.unionByName(
            values.distinct().select(
                "e.*", F.lit(0).cast("long").alias("n"), F.lit(True).alias("known"), *[F.lit(False).alias(n) for n in nulls]
            )
        )
    counted = rows.groupBy("tag", "value").agg(
        F.sum("n").alias("n"),
        F.max("known").alias("known"),
        *[F.count_if((F.col("tag") == 0) & F.col(n)).alias(n) for n in nulls],
    )
    tags = range(1, first_reference + len(spec.references))
    failed = {
        t: (F.col("n") > 1) if t < first_reference else ~F.col("known") & F.col("value")[0].isNotNull() for t in tags
    }
    totals = counted.agg(
        F.coalesce(F.sum(F.when(F.col("tag") == 0, F.col("n"))), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(F.when(F.col("tag") == 0, F.col(n))), F.lit(0)).alias(n) for n in nulls],
        *[
            F.coalesce(
                F.sum(F.when((F.col("tag") == t) & failed[t], F.lit(1) if t < first_reference else F.col("n"))), F.lit(0)
            ).alias(f"_failed_{t}")
            for t in tags
        ],
    )

    def passes(name: str, label: str, column: str) -> tuple[str, str, Column, Column]:
        return (name, label, F.col(column), F.col(column) == 0)

    checks = [("not_empty", "", F.lit(0), F.lit(spec.may_be_empty) | (F.col("_rows") > 0))]
    checks += [passes("not_null", c, n) for c, n in zip(spec.not_null, nulls, strict=True)]
    checks += [passes("unique", ",".join(keys), f"_failed_{t}") for t, keys in enumerate(spec.unique, start=1)]
    checks += [
        passes("references", column, f"_failed_{t}")
        for t, (column, _, _) in enumerate(spec.references, start=first_reference)
    ]
    return _report(totals, spec.table_name, checks)


def run_checks(
    spark: SparkSession,
    specs: Sequence[CheckSpec | dict],
    fail: bool = True,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run table-driven checks and return the report; raise on failure when ``fail``.

    A spec may also be given as ``{"table_name": …, "not_null": column or columns}``.
    ``tables`` gives rows to check under a name, in place of the catalog's table.
    """
    tables = tables or {}
    reports: list[DataFrame] = []
    for spec in specs:
        if isinstance(spec, dict):
            wanted = spec.get("not_null", ())
            spec = CheckSpec(
                **{**spec, "not_null": [wanted] if isinstance(wanted, str) else list(wanted)}
            )
        name = spec.table_name
        reports.append(check_table(tables[name] if name in tables else spark.table(name), spec, tables))
    report = reduce(DataFrame.unionByName, reports)
    if not fail:
        return report
    # one row per check: small whatever the size of the tables
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise DataQualityError(
            "; ".join(
                f"{r['table_name']}: {r['check_name']}"
                + (f"({r['column_name']})" if r["column_name"] else "")
                + f" failed for {r['failed_count']} of {r['row_count']} rows"
                for r in failed
            )
        )
    return spark.createDataFrame(rows, report.schema)


def require(df: DataFrame, all_of: Sequence[str] = (), any_of: Sequence[str] = ()) -> DataFrame:
    """Keep rows where every ``all_of`` column and at least one ``any_of`` column is set."""
    return df.where(present(all_of, any_of))


def present(all_of: Sequence[str] = (), any_of: Sequence[str] = ()) -> Column:
    condition = F.lit(True)
    for c in all_of:
        condition = condition & F.col(f"`{c}`").isNotNull()
    if any_of:
        condition = condition & F.coalesce(*[F.col(f"`{c}`").cast("string") for c in any_of]).isNotNull()
    return condition


def profile_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total rows, NULLs per column and rows with a NULL in any of them, in one pass."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(f"`{c}`").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_null).alias("corrupt_count"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in columns],
    )


def casing_variants(df: DataFrame, array: str, pattern: str, alias: str = "label") -> DataFrame:
    """Distinct spellings in ``array`` that match a case-insensitive pattern."""
    return (
        df.select(F.explode(array).alias(alias)).where(F.col(alias).rlike(f"(?i){pattern}")).distinct()
    )


def numeric_labels(df: DataFrame, array: str, alias: str = "label") -> DataFrame:
    """Distinct labels in ``array`` that are numbers above zero."""
    return (
        df.select(F.explode(array).alias(alias))
        .withColumn("number", F.col(alias).try_cast("int"))
        .where(F.col("number") > 0)
        .distinct()
    )
