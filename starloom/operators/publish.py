"""Check before publish: tables whose rows become visible all at once.

The tables of a set lie under one folder. Every batch writes its rows into folders of its
own, checks them there, and then publishes a new version of the manifest, a short list
that says which folders make up each table. Readers only follow the latest manifest,
so a batch is visible in all tables or in none, a failed check leaves everything as it was,
and no row is written twice. The manifest also holds, per stream, the last batch that
was published: a batch that is repeated after a failure is known by its number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.quality import CheckSpec, run_checks
from starloom.schemas import align

_ENTRY = "name string, folder string, batch long, place int"


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    folders: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    """Table → its folders, relative to the root, oldest first."""
    batches: Mapping[str, int] = field(default_factory=dict)
    """Stream → number of the last batch published."""


def current(spark: SparkSession, root: str) -> Manifest:
    """The latest manifest; an empty one before the first publication."""
    try:
        listed = spark.read.schema(f"{_ENTRY}, version int").json(f"{root}/manifest")
        version = listed.agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        version = None
    if version is None:
        return Manifest()
    folders: dict[str, list[str]] = {}
    batches: dict[str, int] = {}
    # one row per folder and stream
    for row in listed.where(F.col("version") == version).orderBy("place").collect():
        if row["folder"] is None:
            batches[row["name"]] = row["batch"]
        else:
            folders.setdefault(row["name"], []).append(row["folder"])
    return Manifest(version, {k: tuple(v) for k, v in folders.items()}, batches)


def _put(spark: SparkSession, root: str, manifest: Manifest) -> None:
    rows = [(name, folder, None) for name, all_of in manifest.folders.items() for folder in all_of]
    rows += [(name, None, batch) for name, batch in manifest.batches.items()]
    entries = spark.createDataFrame([(*r, place) for place, r in enumerate(rows)], _ENTRY)
    # a version is written once: of two publishers the later one fails
    entries.coalesce(1).write.mode("errorifexists").json(f"{root}/manifest/version={manifest.version}")


def read_published(
    spark: SparkSession, root: str, table: str, schema: T.StructType, manifest: Manifest | None = None
) -> DataFrame:
    """The published rows of a table; none before its first publication."""
    folders = (manifest or current(spark, root)).folders.get(table, ())
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def write_pending(
    df: DataFrame, root: str, table: str, schema: T.StructType, stream: str, batch: int
) -> DataFrame:
    """Rows of a batch in their own folder, read back; a repeated batch replaces its folder."""
    path = f"{root}/{_folder(table, stream, batch)}"
    align(df, schema).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _folder(table: str, stream: str, batch: int) -> str:
    return f"data/{table}/{stream}-{batch}"


def publish_batch(
    spark: SparkSession,
    root: str,
    manifest: Manifest,
    stream: str,
    batch: int,
    pending: Mapping[str, DataFrame],
    specs: Sequence[CheckSpec] = (),
    parents: Mapping[str, DataFrame] | None = None,
) -> tuple[Manifest, DataFrame | None]:
    """Check the pending rows of a batch, then make them part of their tables.

    ``pending`` holds what :func:`write_pending` returned, per table. Checks see
    these rows; ``parents`` gives tables that references look up. A failed check raises
    and leaves the published tables as they were. Returns the new manifest and the report.
    """
    report = run_checks(spark, specs, tables={**(parents or {}), **pending}) if specs else None
    folders = dict(manifest.folders)
    for table in pending:
        folders[table] = (*folders.get(table, ()), _folder(table, stream, batch))
    after = Manifest(manifest.version + 1, folders, {**manifest.batches, stream: batch})
    _put(spark, root, after)
    return after, report


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType) -> Manifest:
    """Rewrite a table of many folders into one and publish that; the rows stay the same."""
    manifest = current(spark, root)
    rows = read_published(spark, root, table, schema, manifest)
    write_pending(rows.hint("rebalance"), root, table, schema, "compact", manifest.version)
    folders = {**manifest.folders, table: (_folder(table, "compact", manifest.version),)}
    after = Manifest(manifest.version + 1, folders, manifest.batches)
    _put(spark, root, after)
    return after


def register_views(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType], prefix: str = "") -> None:
    """Temporary views ``prefix`` + table over the published tables, for SQL."""
    manifest = current(spark, root)
    for table, schema in schemas.items():
        read_published(spark, root, table, schema, manifest).createOrReplaceTempView(f"{prefix}{table}")
