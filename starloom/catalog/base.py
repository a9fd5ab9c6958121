"""Binding helpers: load a table, register a query, give results portable types."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None
    """The same result in SQL, or None where SQL cannot state it."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Types that read the same from Spark and from the SQL check.

    Whole numbers become bigint, decimals double, times text, string arrays one
    ``|``-joined text.
    """

    def convert(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, "|")
        return column.alias(field.name)

    return df.select(*[convert(f) for f in df.schema])


class Registry(dict[str, Query]):
    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Builder], Builder]:
        def register(build: Builder) -> Builder:
            @wraps(build)
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                spark.conf.set("spark.sql.session.timeZone", "UTC")
                return portable(build(spark, sf_dir))

            self[name or build.__name__] = Query(run, sql)
            return build

        return register
