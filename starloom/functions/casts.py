"""Type cleaning for text inputs: a value that does not parse becomes NULL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WHOLE_NUMBERS = {"tinyint", "smallint", "int", "bigint"}


def lenient_cast(column: Column, data_type: T.DataType | str) -> Column:
    """``try_cast``; integers may also be written in scientific notation (1.54E+12)."""
    if isinstance(data_type, T.ArrayType | T.StructType | T.MapType):
        return column.cast(data_type)
    plain = column.try_cast(data_type)
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    if name in _WHOLE_NUMBERS:
        return F.coalesce(plain, column.try_cast("string").try_cast("double").try_cast(data_type))
    return plain


def strict_cast(column: Column, data_type: T.DataType | str, name: str) -> Column:
    """The same value in the target type; one that does not fit fails the job.

    A blank text counts as missing. Fractions beyond a decimal's scale are rounded.
    """
    if isinstance(data_type, T.ArrayType | T.StructType | T.MapType):
        return column.cast(data_type)
    cast = lenient_cast(column, data_type)
    given = column.isNotNull() & (F.trim(column.cast("string")) != "")
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    message = F.concat(F.lit(f"column {name}: no {kind}: "), column.cast("string"))
    return F.when(given & cast.isNull(), F.raise_error(message).cast(data_type)).otherwise(cast)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast the named columns; all others pass through unchanged."""
    return df.withColumns({c: lenient_cast(F.col(f"`{c}`"), t) for c, t in types.items()})


def fill_unknown(column: Column, sentinel: int = -1) -> Column:
    """NULL key → the key of the "unknown" dimension row."""
    return F.coalesce(column, F.lit(sentinel))
