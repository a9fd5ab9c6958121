"""GeoJSON zones → one row per feature with its edges as an array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"

_FEATURES = (
    "features array<struct<"
    "geometry:struct<type:string,coordinates:string>,"
    "properties:map<string,string>>>"
)


def ring_edges(ring: Column) -> Column:
    """Consecutive vertices of a ring → edges; an open ring is closed.

    Each vertex is an array ``[x, y, ...]``.
    """
    closed = F.when(
        F.element_at(ring, 1) == F.element_at(ring, -1), ring
    ).otherwise(F.concat(ring, F.slice(ring, 1, 1)))
    return F.transform(
        F.arrays_zip(
            F.slice(closed, F.lit(1), F.size(closed) - 1).alias("a"),
            F.slice(closed, F.lit(2), F.size(closed) - 1).alias("b"),
        ),
        lambda pair: F.struct(
            pair["a"][0].alias("x1"),
            pair["a"][1].alias("y1"),
            pair["b"][0].alias("x2"),
            pair["b"][1].alias("y2"),
        ),
    )


def read_zone_polygons(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """FeatureCollections → ``ord``, ``location_id``, ``zone``, ``borough``, ``edges``.

    ``ord`` is a feature's place over all files: files by name, then features as they stand in the
    file. So where zones overlap the first one of the first file comes first, however the
    files are read. Polygon and MultiPolygon rings (outer rings and holes alike) are
    flattened into one edge list: crossing parity needs no more. A FeatureCollection is a
    single JSON document, so one task splits a file into features, once; their geometry
    stays text there, and is parsed after features are dealt out over tasks.
    """
    paths = path if isinstance(path, str) else list(path)
    # names only, no content: one per file, as Spark keeps them to plan the scan
    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"))
    names = F.array(*[F.lit(r["file"]) for r in files.distinct().orderBy("file").collect()]).cast("array<string>")
    features = (
        spark.read.schema(_FEATURES)
        .option("multiLine", "true")
        .json(paths)
        .select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("place", "feature"))
        .select(
            # a file holds fewer than 2**31 features
            (F.shiftleft((F.array_position(names, F.col("file")) - 1).cast("bigint"), 31) + F.col("place")).alias("ord"),
            "feature",
        )
        .repartition("ord")
    )
    text = F.col("feature.geometry.coordinates")
    kind = F.col("feature.geometry.type")
    rings = F.when(kind == "Polygon", F.from_json(text, "array<array<array<double>>>")).when(
        kind == "MultiPolygon",
        F.flatten(F.from_json(text, "array<array<array<array<double>>>>")),
    )
    props = F.col("feature.properties")
    return features.select(
        "ord",
        props["location_id"].try_cast("int").alias("location_id"),
        props["zone"].alias("zone"),
        props["borough"].alias("borough"),
        rings.alias("_rings"),
    ).select(
        "ord",
        "location_id",
        "zone",
        "borough",
        F.flatten(F.transform("_rings", ring_edges)).cast(f"array<{EDGE}>").alias("edges"),
    )
