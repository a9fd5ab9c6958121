"""Table DDL from the schema registry, and the data dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import CITY_MODEL, LOOKUP_MODEL, MUSIC_MODEL

MODELS: dict[str, Mapping[str, T.StructType]] = {
    "music": MUSIC_MODEL,
    "city": CITY_MODEL,
    "lookup": LOOKUP_MODEL,
}


def create_model(
    spark: SparkSession,
    model: str | Mapping[str, T.StructType],
    database: str | None = None,
    recreate: bool = False,
    location: str | None = None,
) -> list[str]:
    """Create the model's Parquet tables; ``recreate`` drops them first.

    ``location`` makes them external tables in sub-folders of a shared folder. Returns
    the qualified table names.
    """
    tables = MODELS[model] if isinstance(model, str) else model
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for table, schema in tables.items():
        name = f"`{database}`.`{table}`" if database else f"`{table}`"
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
        names.append(name.replace("`", ""))
    return names


def drop_model(
    spark: SparkSession, model: str | Mapping[str, T.StructType], database: str | None = None
) -> None:
    for table in MODELS[model] if isinstance(model, str) else model:
        spark.sql(f"DROP TABLE IF EXISTS {f'`{database}`.' if database else ''}`{table}`")


def data_dictionary(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """table_name, position, col_name, data_type, comment of the given tables."""

    def describe(table: str) -> DataFrame:
        fields = spark.table(table).schema
        position = F.array_position(F.array(*[F.lit(f.name) for f in fields]), F.col("col_name"))
        return spark.sql(f"DESCRIBE TABLE {table}").select(
            F.lit(table).alias("table_name"),
            position.cast("int").alias("position"),
            "col_name",
            "data_type",
            "comment",
        )

    return reduce(DataFrame.unionByName, [describe(t) for t in tables])
