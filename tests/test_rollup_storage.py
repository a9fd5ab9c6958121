"""Mergeable roll-ups, identities over loads, bucketed tables, heads of CSV files, several GeoJSON files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import operators as op
from starloom.operators.rollup import RollUp, add_batch, merge_batch, rebuild
from starloom.operators.sinks import bucket_spec, upsert_buckets
from starloom.operators.surrogate import next_identity
from starloom.plans import daily
from starloom.plans.model import create_model, drop_model
from starloom.schemas import _schema
from starloom.sources.files import csv_headers, merge_csv, read_csv_strings
from starloom.sources.geo import read_zone_polygons

ROWS = "date_key int, zone int, people int, labels array<string>"


def rollup(arrays=True):
    return RollUp(
        ["date_key", "zone"],
        F.col("date_key"),
        {"n": F.lit(1), "people": F.col("people")},
        {"labels": "labels"} if arrays else {},
    )


def whole(df, arrays=True):
    """The same groups from all rows at once."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("people").alias("people")]
    if arrays:
        aggs.append(F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.coalesce("labels", F.array().cast("array<string>"))))))).alias("labels"))
    return df.groupBy("date_key", "zone").agg(*aggs)


BATCHES = [
    [(1, 7, 2, ["a", "b"]), (1, 7, None, ["b", None]), (2, 7, 1, None), (None, 7, 1, ["x"]), (3, None, 4, [])],
    [(1, 7, 5, ["c", "a"]), (1, 8, 1, ["a"]), (4, 7, 1, ["d"])],
    [(None, 7, 2, ["y"])],
    [],
]


@pytest.mark.parametrize("arrays", [True, False])
def test_batches_equal_one_input(spark, tmp_path, rows, arrays):
    root, spec = str(tmp_path / "r"), rollup(arrays)
    touched = []
    for number, batch in enumerate(BATCHES):
        frame = spark.createDataFrame(batch, ROWS)
        for _ in range(2):  # a repeated batch replaces itself
            found = merge_batch(spec, frame, root, number)
        touched.append(found)
    assert touched == [[None, 1, 2, 3], [1, 4], [None], []]
    everything = spark.createDataFrame([r for b in BATCHES for r in b], ROWS)
    assert rows(spark.read.parquet(f"{root}/table").drop("_period")) == rows(whole(everything, arrays))


def test_only_touched_periods_are_written(spark, tmp_path):
    root, spec = tmp_path / "r", rollup()
    merge_batch(spec, spark.createDataFrame(BATCHES[0], ROWS), str(root), 0)

    def files():
        return {p.relative_to(root): p.stat().st_mtime_ns for p in (root / "table").rglob("*.parquet")}

    before = files()
    periods = add_batch(spec, spark.createDataFrame(BATCHES[1], ROWS), str(root / "state"), 1)
    assert files() == before
    # input of earlier batches is not needed, and partials of other periods are not read
    for folder in (root / "state" / "_batch=0").glob("_period=[23]"):
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"broken")
    rebuild(spec, spark, str(root / "state"), str(root / "table"), periods)
    after = files()
    same = {p: t for p, t in before.items() if "_period=1" not in str(p)}
    assert same.items() <= after.items()
    assert {p for p in before if "_period=1" in str(p)}.isdisjoint(after)


def test_periods():
    with pytest.raises(ValueError, match="unknown period"):
        daily.trip_rollup("week")


# ---- identities ------------------------------------------------------------------

NUMBERED = _schema(id=T.LongType(), v=T.StringType())


@pytest.fixture
def numbered(spark):
    create_model(spark, {"numbered_t": NUMBERED}, recreate=True)
    yield "numbered_t"
    drop_model(spark, {"numbered_t": NUMBERED})


def test_ids_go_on_over_loads(spark, numbered, rows):
    def load(*values):
        return op.append_with_identity(spark.createDataFrame([(v,) for v in values], "v string"), numbered, "id", ["v"], 1)

    assert load("b", "a", "c") == (1, 4)
    first = rows(spark.table(numbered))
    assert first == [(1, "a"), (2, "b"), (3, "c")]
    assert op.append_with_identity(spark.createDataFrame([], "v string"), numbered, "id", ["v"]) == (4, 4)
    assert load("z", "y") == (4, 6)
    assert rows(spark.table(numbered)) == [*first, (4, "y"), (5, "z")]
    # rows that go later do not free their ids
    op.overwrite_table(spark.createDataFrame(first[:2], "id long, v string"), numbered)
    assert load("x") == (6, 7)


def test_ids_of_a_table_without_a_mark(spark, numbered):
    assert next_identity(spark, numbered, "id", 5) == 5
    op.append_table(spark.createDataFrame([(41, "x")], "id long, v string"), numbered)
    assert next_identity(spark, numbered, "id", 5) == 42


# ---- bucketed tables ---------------------------------------------------------------


@pytest.fixture
def bucketed(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bucketed_t")
    items = spark.range(5000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 100).cast("int").alias("k"),
        ((F.col("id") * 7919) % 5000).alias("item"),
    )
    op.create_bucketed(items, "bucketed_t", ["k"], ["item"], buckets=8, path=str(tmp_path / "b"))
    yield items
    spark.sql("DROP TABLE bucketed_t")


def test_a_lookup_opens_one_file_in_order(spark, bucketed, tmp_path):
    stored = spark.table("bucketed_t")
    where = {r[0].rsplit("/", 1)[1] for r in stored.where("k = 7").select("_metadata.file_path").distinct().collect()}
    assert len(where) == 1
    for file in (tmp_path / "b").glob("*.parquet"):
        if file.name not in where:
            file.write_bytes(b"not to be opened")
    got = [r["item"] for r in op.lookup(stored, k=7).collect()]
    assert got == sorted(r["item"] for r in bucketed.where("k = 7").collect()) and len(got) > 2000
    assert bucket_spec(spark, "bucketed_t") == (8, ["k"], ["k", "item"])


def test_inserts_leave_the_target_where_it_is(spark, bucketed, rows, plan):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.createDataFrame([(7, 1), (500, 1), (500, 1), (None, 2)], "k int, item long")
        spec = bucket_spec(spark, "bucketed_t")
        text = plan(op.insert_new(new.repartition(spec[0], "k"), spark.table("bucketed_t"), ["k"]))
        target = text[text.index("HashAggregate") :] if "HashAggregate" in text else text
        assert "Bucketed: true" in target and "Exchange" not in target
        for _ in range(2):
            op.insert_new_bucketed(new, "bucketed_t", ["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert spark.table("bucketed_t").count() == 5000 + 3 + 1  # a row without a key is always new
    assert rows(op.lookup(spark.table("bucketed_t"), k=500)) == [(500, 1), (500, 1)]
    assert bucket_spec(spark, "bucketed_t")[0] == 8
    with pytest.raises(ValueError, match="no buckets by"):
        op.insert_new_bucketed(new, "bucketed_t", ["item"])


def test_divided_folders_keep_their_number(spark, tmp_path):
    path = str(tmp_path / "u")
    df = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    upsert_buckets(df, path, ["k"], buckets=64)
    with pytest.raises(ValueError, match="divided into 64 by"):
        upsert_buckets(df, path, ["k"], buckets=32)
    with pytest.raises(ValueError, match="divided into 64 by"):
        upsert_buckets(df, path, ["v"], buckets=64)
    upsert_buckets(df.withColumn("v", F.lit("b")), path, ["k"], buckets=64)
    stored = spark.read.parquet(path)
    assert stored.count() == 200 and stored.where("v = 'b'").count() == 200


# ---- CSV heads -------------------------------------------------------------------


def test_headers_come_from_the_heads_of_files(spark, tmp_path, monkeypatch):
    from starloom.sources import files

    monkeypatch.setattr(files, "_HEAD", 5)
    (tmp_path / "a.csv").write_text('"one\nline","t""wo",three\n1,2,3\n')
    (tmp_path / "b c.csv").write_text("x,y\r\n1,2\r\n")
    (tmp_path / "d.csv").write_text("﻿x,y")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv.gz").write_bytes(gzip.compress(b"x,y\n5,6\n"))
    found = csv_headers(spark, str(tmp_path))
    assert {k: sorted(f.rsplit("/", 1)[1] for f in v) for k, v in found.items()} == {
        ("one\nline", 't"wo', "three"): ["a.csv"], ("x", "y"): ["b c.csv", "d.csv", "f.csv.gz"],
    }
    merged = merge_csv(spark, str(tmp_path))
    assert sorted(merged.columns) == sorted(["one\nline", 't"wo', "three", "x", "y"])
    assert sorted(tuple(r) for r in merged.where("x IS NOT NULL").select("x", "y").collect()) == [("1", "2"), ("5", "6")]


def test_one_large_file_in_several_tasks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f"{i},{i % 7}\n" for i in range(50_000)))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        split = read_csv_strings(spark, str(tmp_path), multi_line=False)
        parts = [r["n"] for r in split.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(parts) > 3 and sum(parts) == 50_000
        merged = merge_csv(spark, str(tmp_path), multi_line=False)
        assert merged.where("a = '49999'").count() == 1 and merged.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


# ---- GeoJSON ---------------------------------------------------------------------


def collection(*zones):
    def feature(number, x):
        ring = [[x, 0], [x + 10, 0], [x + 10, 10], [x, 10], [x, 0]]
        return {
            "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]},
            "properties": {"location_id": str(number), "zone": f"Z{number}", "borough": "B"},
        }

    return json.dumps({"type": "FeatureCollection", "features": [feature(*z) for z in zones]})


def test_first_file_wins(spark, tmp_path, rows):
    (tmp_path / "b zones.json").write_text(collection((1, 0), (2, 20)))
    (tmp_path / "a.json").write_text(collection((11, 5), (12, 100)))
    zones = read_zone_polygons(spark, str(tmp_path))
    assert [r["location_id"] for r in zones.orderBy("ord").collect()] == [11, 12, 1, 2]
    points = spark.createDataFrame([("both", 7.0, 5.0), ("b", 2.0, 5.0), ("none", 50.0, 5.0)], "n string, x double, y double")
    located = op.locate_points(points, zones, "x", "y", alias="z").select("n", "z.location_id")
    assert rows(located) == [("b", 1), ("both", 11), ("none", None)]


def test_geometry_is_parsed_in_several_tasks(spark, tmp_path):
    (tmp_path / "z.json").write_text(collection(*[(k, k * 20) for k in range(200)]))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        zones = read_zone_polygons(spark, str(tmp_path))
        parts = zones.where(F.size("edges") == 4).groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1 and sum(r["count"] for r in parts) == 200
        text = zones._jdf.queryExecution().optimizedPlan().toString()
        assert text.index("from_json") < text.index("Repartition")  # the parse stands above the exchange
        assert text.count("Relation") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_preview(spark, rows):
    df = spark.createDataFrame([(1, "a long value", None), (2, "short", [1])], "k int, v string, l array<int>").orderBy("k")
    assert rows(op.preview(df, 1, 8)) == [("1", "a lon...", "NULL")]
    assert op.preview(df, 5, 8).count() == 2
    with pytest.raises(ValueError):
        op.preview(df, 5, 3)
