"""Writers and table load modes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import insert_new
from starloom.operators.keyed import upsert
from starloom.schemas import align
from starloom.session import shared_dir
from starloom.sources.staging import stage_json


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    sort_within: Sequence[str] = (),
) -> None:
    """Write Parquet, optionally in partition folders.

    With ``partition_by`` the rows are first rebalanced on those columns: few files per
    folder, while AQE splits a folder that holds a large share of the rows over several
    tasks. ``dynamic`` overwrites only the folders that receive rows.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv_quoted(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    """CSV with a header and every field quoted."""
    selected = df.select(*columns) if columns else df
    (
        selected.write.mode(mode)
        .option("header", "true")
        .option("quoteAll", "true")
        .option("escape", '"')
        .csv(path)
    )


def materialize(
    df: DataFrame, table: str, reuse: bool = False, path: str | None = None
) -> DataFrame:
    """Store an expensive step as a table and read it back; ``reuse`` skips the work.

    ``path`` puts the files in a folder of the caller's choice instead of the warehouse.
    """
    spark = df.sparkSession
    if not (reuse and spark.catalog.tableExists(table)):
        writer = df.write.mode("overwrite").format("parquet")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
    return spark.table(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the table's rows; columns are matched by name and cast to its types."""
    align(df, df.sparkSession.table(table).schema).write.insertInto(table, overwrite=True)


def append_table(df: DataFrame, table: str) -> None:
    align(df, df.sparkSession.table(table).schema).write.insertInto(table, overwrite=False)


def load_dimension(df: DataFrame, table: str, mode: str = "insert") -> None:
    """``truncate`` replaces the dimension, ``insert`` appends to it."""
    modes = {"truncate": overwrite_table, "insert": append_table}
    if mode.lower() not in modes:
        raise ValueError(f"unknown load mode {mode!r}, use one of {sorted(modes)}")
    modes[mode.lower()](df, table)


def stage_table(
    spark: SparkSession,
    path: str,
    table: str,
    paths: Mapping[str, str] | None = None,
    mode: str = "append",
) -> None:
    """Stage JSON files into an existing table: by field name, or by ``paths`` where given."""
    rows = stage_json(spark, path, spark.table(table).schema, paths)
    {"append": append_table, "overwrite": overwrite_table}[mode](rows, table)


def load_fact(df: DataFrame, table: str) -> None:
    append_table(df, table)


def insert_new_rows(
    df: DataFrame, table: str, keys: Sequence[str], null_aware: bool = False
) -> None:
    """Append only the rows whose key the table does not hold yet."""
    append_table(insert_new(df, df.sparkSession.table(table), keys, null_aware), table)


def upsert_table(
    df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str] = ()
) -> None:
    """Insert rows, replacing those of equal key; the last write wins.

    The merged rows are checkpointed on shared storage before the table is overwritten,
    so the job never reads files it is replacing.
    """
    spark = df.sparkSession
    shared_dir(spark)
    merged = upsert(spark.table(table), df, keys, order_by).checkpoint()
    overwrite_table(merged, table)


def upsert_buckets(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    buckets: int = 64,
) -> None:
    """Upsert into a Parquet folder that is divided by a hash of the keys (``_bucket``).

    Only the divisions that the batch touches are read, merged and overwritten; the
    files of all others stay. The folder is created by the first call, which keeps its keys and
    number of divisions beside the rows; a later call that names others is an error. The merged
    rows are checkpointed on shared storage before their divisions are replaced.
    """
    spark = df.sparkSession
    shared_dir(spark)
    layout = f"{path.rstrip('/')}/_layout"  # Spark's readers skip names that begin with "_"
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    incoming = df.withColumn("_bucket", bucket)
    kept = _read_or_none(spark, layout, "buckets int, keys array<string>")
    if kept is None:
        if _read_or_none(spark, path) is not None:
            raise ValueError(f"{path} holds rows but not how they are divided")
        spark.createDataFrame([(buckets, list(keys))], "buckets int, keys array<string>").write.json(layout)
        columns = [c for c in df.columns if c not in order_by or c in keys]
        target = incoming.select(*columns, "_bucket").limit(0)
    else:
        made = kept.first()
        if (made["buckets"], made["keys"]) != (buckets, list(keys)):
            raise ValueError(f"{path} is divided into {made['buckets']} by {made['keys']}, not {buckets} by {list(keys)}")
        target = _read_or_none(spark, path)
        if target is None:  # the first call died before it wrote rows
            columns = [c for c in df.columns if c not in order_by or c in keys]
            target = incoming.select(*columns, "_bucket").limit(0)
    touched = [r["_bucket"] for r in incoming.select("_bucket").distinct().collect()]  # at most ``buckets``
    old = target.where(F.col("_bucket").isin(touched))
    merged = upsert(old, incoming, keys, order_by).checkpoint()
    write_parquet(merged, path, ["_bucket"], dynamic=True)


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Parquet rows (JSON ones where a schema is given) of a folder, None where it has none."""
    try:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def create_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    clustering: Sequence[str] = (),
    buckets: int = 64,
    path: str | None = None,
) -> None:
    """Store rows in a table of ``buckets`` files by a hash of ``keys``, sorted by keys and clustering.

    A lookup by all keys opens one file and finds its rows in clustering order; a join or
    aggregate on the keys needs no shuffle of this table. All rows of one key are in one
    file: for keys that hold a large share of the rows, :func:`cluster_for_lookup` cuts
    them by range instead.
    """
    placed = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *clustering)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str], list[str]] | None:
    """Number of buckets, bucket columns and sort columns of a table, None where it has no buckets."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in told:
        return None

    def names(text: str) -> list[str]:
        return [n.strip().strip("`") for n in text.strip("[]").split(",") if n.strip()]

    return int(told["Num Buckets"]), names(told["Bucket Columns"]), names(told.get("Sort Columns", ""))


def insert_new_bucketed(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Append rows of new keys to a table that :func:`create_bucketed` made by the same keys.

    The anti join reads the target bucket by bucket where it lies: only the incoming rows
    are shuffled, to the target's buckets, and are written there. Of incoming rows with one key
    all are kept, as by :func:`insert_new_rows`; a row with a NULL key is new.
    """
    spark = df.sparkSession
    spec = bucket_spec(spark, table)
    if spec is None or spec[1] != list(keys):
        raise ValueError(f"{table} has no buckets by {list(keys)}")
    buckets, _, order = spec
    target = spark.table(table)
    rows = align(df, target.schema)
    # stored before the target gets files, which the anti join would otherwise meet
    fresh = insert_new(rows.repartition(buckets, *[F.col(f"`{k}`") for k in keys]), target, keys).checkpoint()
    placed = fresh.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    placed.write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*order).saveAsTable(table)
