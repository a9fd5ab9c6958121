"""JSON → staging rows, matched by field name or through a path mapping."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.casts import lenient_cast
from starloom.functions.dates import epoch_ms_to_timestamp

_STEP = re.compile(r"\.([A-Za-z_][\w-]*)|\['([^']+)'\]|\[\"([^\"]+)\"\]")


def _steps(path: str) -> list[str] | None:
    """``$.a['b']`` → ``["a", "b"]``; None when the path has array steps or wildcards."""
    rest, steps = path.strip()[1:], []
    while rest:
        match = _STEP.match(rest)
        if not match:
            return None
        steps.append(next(g for g in match.groups() if g is not None))
        rest = rest[match.end():]
    return steps or None


def _typed(raw: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        by_text = raw.try_cast("timestamp")
        return F.coalesce(
            epoch_ms_to_timestamp(lenient_cast(raw, "bigint"), whole_seconds=False), by_text
        ).alias(field.name)
    return lenient_cast(raw, field.dataType).alias(field.name)


def _tree(paths: list[list[str]]) -> dict:
    root: dict = {}
    for steps in paths:
        node = root
        for step in steps:
            node = node.setdefault(step, {})
    return root


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(k, _struct(v) if v else T.StringType()) for k, v in tree.items()]
    )


def _by_path(
    df: DataFrame, column: str, schema: T.StructType, paths: Mapping[str, str]
) -> DataFrame:
    """Plain object paths share one parse of the text; a path with array steps is taken alone."""
    plain = {c: s for c, p in paths.items() if (s := _steps(p)) is not None}
    # a path that is also a prefix of another must keep its raw text
    shared = {
        c: s
        for c, s in plain.items()
        if not any(o != s and o[: len(s)] == s for o in plain.values())
    }
    text = F.col(f"`{column}`")
    parsed = df.select(
        text.alias("_text"),
        *([F.from_json(text, _struct(_tree(list(shared.values())))).alias("_parsed")] if shared else []),
    )

    def raw(field: T.StructField) -> Column:
        if field.name in shared:
            value = F.col("_parsed")
            for step in shared[field.name]:
                value = value.getField(step)
            return value
        if field.name in paths:
            return F.get_json_object("_text", paths[field.name])
        return F.lit(None).cast("string")

    return parsed.select(*[_typed(raw(f), f) for f in schema])


def _by_name(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Top-level fields by lower-cased name; of repeated names the first counts."""
    fields = df.select(F.from_json(F.col(f"`{column}`"), "map<string,string>").alias("_map")).select(
        F.transform(F.map_keys("_map"), F.lower).alias("_names"), F.map_values("_map").alias("_values")
    )

    def raw(field: T.StructField) -> Column:
        place = F.array_position("_names", field.name.lower()) - 1
        return F.get("_values", place.cast("int"))

    return fields.select(*[_typed(raw(f), f) for f in schema])


def stage_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    paths: Mapping[str, str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Stage JSON lines into ``schema``.

    ``paths`` maps column → JSON path; without it fields are matched to columns by
    name in any letter case. Values that do not fit the column type become NULL, and
    epoch milliseconds are accepted for timestamp columns.
    """
    lines = spark.read.text(path, recursiveFileLookup=recursive).where(F.length(F.trim("value")) > 0)
    return stage_json_text(lines, "value", schema, paths)


def stage_json_text(
    df: DataFrame, column: str, schema: T.StructType, paths: Mapping[str, str] | None = None
) -> DataFrame:
    """As :func:`stage_json`, for JSON text that is already a column."""
    if paths is not None:
        return _by_path(df, column, schema, paths)
    return _by_name(df, column, schema)


def read_json_paths(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, str]:
    """Mapping file ``{"jsonpaths": ["$['a']", ...]}``: n-th path fills n-th column."""
    document = spark.read.text(path, wholetext=True).first()[0]
    entries = json.loads(document)["jsonpaths"]
    if len(entries) != len(schema):
        raise ValueError(f"{len(entries)} paths for {len(schema)} columns")
    return dict(zip(schema.names, entries, strict=True))
