import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import operators as op
from starloom.plans.model import create_model, data_dictionary, drop_model
from starloom.schemas import STAGING_EVENTS, align
from starloom.session import shared_dir, work_path
from starloom.sources import (
    merge_csv,
    read_csv_strings,
    read_json,
    read_json_paths,
    read_parquet,
    read_table,
    stage_json,
)
from starloom.streaming import stage_incremental

TARGET = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("ts", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return str(path)


def test_json_tree_by_glob_and_recursively(spark, tmp_path, rows):
    for sub, n in (("A/B/C", 1), ("A/D/E", 2)):
        write_lines(tmp_path / sub / f"{n}.json", [{"song_id": f"S{n}", "year": n, "artist_latitude": None}])
    schema = T.StructType([T.StructField("song_id", T.StringType()), T.StructField("year", T.IntegerType())])
    by_glob = read_json(spark, f"{tmp_path}/*/*/*/*.json", schema)
    assert rows(by_glob) == [("S1", 1), ("S2", 2)]
    assert rows(read_json(spark, str(tmp_path), schema, recursive=True)) == rows(by_glob)
    assert read_json(spark, f"{tmp_path}/*/*/*/*.json").columns == ["artist_latitude", "song_id", "year"]


def test_stage_by_name_ignores_case_and_bad_values(spark, tmp_path):
    path = write_lines(
        tmp_path / "log.json",
        [
            {"USERID": "", "ts": 1541121934796, "Song": "A", "at": 1541121934796},
            "",
            {"userid": 7, "ts": "1.54111E+12", "other": {"x": 1}, "at": "2018-11-02 01:25:34"},
        ],
    )
    got = [tuple(r) for r in stage_json(spark, path, TARGET).select("userId", "ts", "song", F.col("at").cast("string")).collect()]
    assert got == [
        (None, 1541121934796, "A", "2018-11-02 01:25:34.796"),
        (7, 1541110000000, None, "2018-11-02 01:25:34"),
    ]


def test_stage_through_paths(spark, tmp_path):
    path = write_lines(tmp_path / "log.json", [{"u": {"id": 5, "n": [1, 2]}, "t": 9, "weird key": "s"}])
    paths = {"userId": "$.u.id", "ts": "$.u.n[1]", "song": "$['weird key']"}
    assert tuple(stage_json(spark, path, TARGET, paths).first()) == (5, 2, "s", None)
    whole = {"song": "$.u", "userId": "$.u.id"}
    row = stage_json(spark, path, TARGET, whole).first()
    assert json.loads(row["song"]) == {"id": 5, "n": [1, 2]} and row["userId"] == 5


def test_json_paths_file_is_positional(spark, tmp_path):
    mapping = tmp_path / "paths.json"
    mapping.write_text(json.dumps({"jsonpaths": ["$['b']", "$['a']"]}, indent=2))
    schema = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.IntegerType())])
    paths = read_json_paths(spark, str(mapping), schema)
    data = write_lines(tmp_path / "d.json", [{"a": 1, "b": "t"}])
    assert tuple(stage_json(spark, data, schema, paths).first()) == ("t", 1)
    with pytest.raises(ValueError):
        read_json_paths(spark, str(mapping), TARGET)


def test_csv_merge_headers_quotes_and_scientific_numbers(spark, tmp_path, rows):
    for day, body in (
        ("01", 'Des\'ree,"San Jose, CA",1.54111E+12,8\r\n,"X ""Y""",1.54E+12,\r\n'),
        ("02", "Muse,NY,12,9,extra,fields\r\n"),
    ):
        (tmp_path / f"2018-11-{day}-events.csv").write_text("artist,location,ts,userId\r\n" + body)
    schema = T.StructType(
        [
            T.StructField("userId", T.IntegerType()),
            T.StructField("ts", T.LongType()),
            T.StructField("location", T.StringType()),
            T.StructField("artist", T.StringType()),
        ]
    )
    merged = merge_csv(spark, str(tmp_path), schema)
    assert rows(merged) == [
        (None, 1540000000000, 'X "Y"', None),
        (8, 1541110000000, "San Jose, CA", "Des'ree"),
        (9, 12, "NY", "Muse"),
    ]
    assert merge_csv(spark, f"{tmp_path}/2018-11-0*-events.csv", schema, with_source=True).columns[-1] == "source_file"
    assert {f.dataType for f in read_csv_strings(spark, str(tmp_path)).schema} == {T.StringType()}


def test_csv_quoted_roundtrip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a,b", 'say "x"'), ("c", None)], "p string, q string")
    op.write_csv_quoted(df, str(tmp_path / "out"), ["q", "p"])
    text = "".join(f.read_text() for f in sorted((tmp_path / "out").glob("*.csv")))
    assert '"q","p"' in text and '"say ""x""","a,b"' in text
    assert rows(read_csv_strings(spark, str(tmp_path / "out"))) == [(None, "c"), ('say "x"', "a,b")]


def test_partitioned_write_prunes_and_overwrites_dynamically(spark, tmp_path, rows, plan):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("year"), (F.col("id") % 2).alias("month"))
    op.write_parquet(df, path, ["year", "month"], sort_within=["id"])
    files = list((tmp_path / "t").glob("year=*/month=*/*.parquet"))
    assert len(files) == 4
    one = read_parquet(spark, path).where("year = 1")
    assert one.count() == 25 and "PartitionFilters: [isnotnull(year" in plan(one)
    op.write_parquet(df.where("year = 1").withColumn("id", -F.col("id")), path, ["year", "month"], dynamic=True)
    assert read_parquet(spark, path).where("id < 0").count() == 25
    assert read_parquet(spark, path).count() == 100


def test_align_by_name(spark):
    df = spark.createDataFrame([("5", 1.25)], "KEY string, amount double")
    schema = T.StructType([T.StructField("amount", T.DecimalType(18, 2)), T.StructField("key", T.ByteType())])
    got = align(df, schema)
    assert got.columns == ["amount", "key"] and [str(v) for v in got.first()] == ["1.25", "5"]
    with pytest.raises(ValueError, match="missing"):
        align(df.drop("KEY"), schema)


@pytest.fixture
def accounts(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    create_model(spark, {"accounts_t": schema}, recreate=True)
    yield "accounts_t"
    drop_model(spark, {"accounts_t": schema})


def test_load_modes(spark, accounts, rows):
    df = spark.createDataFrame([("a", "1")], "v string, k string")
    op.load_fact(df, accounts)
    op.load_dimension(df, accounts, "insert")
    assert rows(read_table(spark, accounts)) == [(1, "a"), (1, "a")]
    op.load_dimension(df, accounts, "truncate")
    assert rows(read_table(spark, accounts)) == [(1, "a")]
    with pytest.raises(ValueError):
        op.load_dimension(df, accounts, "replace")


def test_insert_new_rows_twice_adds_nothing(spark, accounts, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        op.insert_new_rows(df, accounts, ["k"], null_aware=True)
    assert rows(read_table(spark, accounts)) == [(1, "a"), (2, "b")]


def test_upsert_table(spark, accounts, rows):
    op.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), accounts, ["k"])
    op.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), accounts, ["k"])
    assert rows(read_table(spark, accounts)) == [(1, "a"), (2, "c"), (3, "d")]


def test_materialize_reuse(spark):
    spark.sql("DROP TABLE IF EXISTS mat_t")
    assert op.materialize(spark.range(3), "mat_t").count() == 3
    assert op.materialize(spark.range(9), "mat_t", reuse=True).count() == 3
    assert op.materialize(spark.range(9), "mat_t").count() == 9
    spark.sql("DROP TABLE mat_t")


def test_create_model_and_dictionary(spark):
    names = create_model(spark, "city", "city_db", recreate=True)
    assert set(names) == {f"city_db.{t}" for t in ("trip_fact", "date_dim", "vendor_dim", "location_dim", "crash_dim")}
    got = data_dictionary(spark, ["city_db.date_dim", "city_db.crash_dim"]).orderBy("table_name", "position")
    kinds = {(r["table_name"], r["col_name"]): r["data_type"] for r in got.collect()}
    assert kinds["city_db.date_dim", "week"] == "tinyint"
    assert kinds["city_db.crash_dim", "vehicle_type_list"] == "array<string>"
    drop_model(spark, "city", "city_db")
    spark.sql("DROP DATABASE city_db")


def test_stage_incremental_loads_each_file_once(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    write_lines(source / "1.json", [{"userId": 1, "ts": 1}, {"userId": 2, "ts": 2}])
    stage_incremental(spark, str(source), STAGING_EVENTS, target, check)
    stage_incremental(spark, str(source), STAGING_EVENTS, target, check)
    assert spark.read.parquet(target).count() == 2
    write_lines(source / "2.json", [{"userid": 3, "ts": 3}])
    stage_incremental(spark, str(source), STAGING_EVENTS, target, check, max_files_per_batch=1)
    assert sorted(r["userId"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_work_paths_lie_in_the_shared_folder_and_differ(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = work_path(spark, "x"), work_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark) + "/")


def test_repeated_field_names_take_the_first(spark):
    from starloom.sources.staging import stage_json_text

    df = spark.createDataFrame([('{"userId": 1, "USERID": 2, "song": null}',), ("not json",)], "v string")
    got = [tuple(r) for r in stage_json_text(df, "v", TARGET).collect()]
    assert got == [(1, None, None, None), (None, None, None, None)]


def test_stage_table_appends_or_overwrites(spark, accounts, tmp_path, rows):
    path = write_lines(tmp_path / "a.json", [{"K": 1, "V": "x"}])
    op.stage_table(spark, path, accounts)
    op.stage_table(spark, path, accounts, {"k": "$.K"})
    assert rows(read_table(spark, accounts)) == [(1, None), (1, "x")]
    op.stage_table(spark, path, accounts, mode="overwrite")
    assert rows(read_table(spark, accounts)) == [(1, "x")]
