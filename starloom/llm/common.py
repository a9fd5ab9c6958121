"""Pieces that several operators share: words, lambda bindings, safe restarts."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import shared_dir, work_path

#: Characters that separate words: blank and the ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: A word, as Java, DuckDB and Python read the pattern.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """The text column; a missing text counts as an empty one."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def settled(df: DataFrame) -> DataFrame:
    """df written to the folder of ``spark.checkpoint.dir`` and read from there.

    Later steps start from the files, so a lost executor costs none of the work before.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As :func:`settled`, through Parquet files, for steps that repeat.

    A checkpoint hands on size estimates, which joins multiply: from round to round they
    would grow beyond all bounds. Files have sizes of their own.
    """
    path = work_path(df.sparkSession, "round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def python_ready(spark: SparkSession, rows: int = 256) -> None:
    """Lets Python workers run this package: its code goes with the application, batches are small.

    Whole texts go to Python, so few rows at a time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="starloom-code-")) / "starloom-code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
