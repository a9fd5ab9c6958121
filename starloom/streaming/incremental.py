"""Once-per-file staging: each input file is loaded by exactly one run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.staging import stage_json_text


def stage_incremental(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    paths: Mapping[str, str] | None = None,
    max_files_per_batch: int | None = None,
) -> None:
    """Append the rows of files not seen before to the Parquet folder ``target``.

    Meant to be started on a schedule: ``availableNow`` drains what is there and ends.
    The checkpoint remembers the files, so a repeated run adds nothing and a run that
    died half-way is completed by the next one. Both folders must be on shared storage.
    """
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    lines = reader.load(path).where(F.length(F.trim("value")) > 0)
    query = (
        stage_json_text(lines, "value", schema, paths)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
