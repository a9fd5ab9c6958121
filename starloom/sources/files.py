"""File and table scans. Paths may be folders, globs or lists of either."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.casts import cast_columns

Paths = str | Sequence[str]


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType | None = None,
    recursive: bool = False,
    fail_on_bad_rows: bool = False,
) -> DataFrame:
    """JSON lines. With a schema Spark skips the extra inference pass over all files."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("mode", "FAILFAST" if fail_on_bad_rows else "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path if isinstance(path, str) else list(path))


def _csv(spark: SparkSession, path: Paths, recursive: bool, multi_line: bool, names: Sequence[str] | None) -> DataFrame:
    reader = (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        .option("recursiveFileLookup", str(recursive).lower())
    )
    if names is not None:
        strings = T.StructType([T.StructField(n, T.StringType()) for n in names])
        # a file whose header has other names, or another order, fails instead of being mixed up
        reader = reader.schema(strings).option("enforceSchema", "false")
    return reader.csv(path if isinstance(path, str) else list(path))


def read_csv_strings(
    spark: SparkSession, path: Paths, recursive: bool = False, multi_line: bool = True
) -> DataFrame:
    """CSV with the same header line in each file; every column stays a string.

    Fields beyond the header are cut off, empty fields are NULL. A file with another
    header is an error; :func:`merge_csv` takes such files. ``multi_line`` reads quoted
    line breaks, at the price of one task per file; off, files are split but a quoted
    line break breaks its row.
    """
    names = _csv(spark, path, recursive, multi_line, None).columns
    return _csv(spark, path, recursive, multi_line, names)


#: Bytes of a file that are read at a time until its header is complete.
_HEAD = 1 << 14


def _header_of(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """Names in the first record of a file; quoted line breaks belong to the record. None for an empty file."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        source = stream if codec is None else codec.createInputStream(stream)
        head = b""
        while True:
            part = bytes(source.readNBytes(_HEAD))
            head += part
            text = head.decode("utf-8", "ignore").removeprefix("\ufeff").lstrip("\r\n")
            end = re.search(r'^(?:[^"\r\n]|"(?:[^"]|"")*")*(?=[\r\n])', text)
            if end or not part:
                record = end[0] if end else text
                return tuple(next(csv.reader(io.StringIO(record, newline="")))) if record else None
    finally:
        stream.close()


def csv_headers(spark: SparkSession, path: Paths, recursive: bool = False) -> dict[tuple[str, ...], list[str]]:
    """Column names → files that begin with them; of each file only the head is opened.

    Files without a header are left out. The driver holds the names of the files, as Spark
    itself does to plan a scan, and no data.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    listed = reader.text(path if isinstance(path, str) else list(path)).inputFiles()
    # as URIs, with blanks written as %20; readers take plain paths
    files = sorted(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f)).toString() for f in listed)
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, names in zip(files, pool.map(lambda f: _header_of(spark, f), files), strict=True):
            if names:
                found.setdefault(names, []).append(file)
    return dict(sorted(found.items()))


def merge_csv(
    spark: SparkSession,
    path: Paths,
    schema: T.StructType | None = None,
    recursive: bool = False,
    with_source: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """All CSV files of a folder as one dataset, each header skipped, typed by name.

    Every file is read by its own header, so files may have their columns in different
    orders; a column that a file lacks is NULL there. Columns are read as text and
    cast afterwards, because a typed CSV read turns integers in scientific notation into
    NULL. ``with_source`` adds ``source_file`` so a caller can order rows of equal keys.
    """
    parts = []
    for names, files in csv_headers(spark, path, recursive).items():
        part = _csv(spark, files, False, multi_line, names)
        if with_source:
            part = part.withColumn("source_file", F.col("_metadata.file_path"))
        parts.append(part)
    if not parts:
        df = read_csv_strings(spark, path, recursive, multi_line)
    else:
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is None:
        return df
    names = {c.lower(): c for c in df.columns}
    extra = ["source_file"] if with_source else []
    df = df.select(*[F.col(f"`{names[f.name.lower()]}`").alias(f.name) for f in schema], *extra)
    return cast_columns(df, {f.name: f.dataType for f in schema})


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    """Parquet scan; filters and column selections reach the files."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
