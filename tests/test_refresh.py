"""Batch-wise refresh, publishing after checks, and checks in one scan."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.catalog import inputs, refresh
from starloom.operators import publish
from starloom.operators.quality import CheckSpec, DataQualityError, check_table, run_checks
from starloom.schemas import MUSIC_MODEL
from starloom.streaming.refresh import refresh_music_by_batch
from tests.test_pipelines import EVENT, SONG


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


@pytest.fixture
def place(tmp_path):
    write(tmp_path / "songs", "1.json", [SONG])
    write(tmp_path / "logs", "1.json", [
        EVENT,
        {**EVENT, "itemInSession": 1, "userId": "4", "song": "Other"},  # one session, one millisecond
        {**EVENT, "sessionId": None, "itemInSession": 2},
        {**EVENT, "page": "Home", "userId": ""},
    ])
    return tmp_path


def run(spark, place):
    return refresh_music_by_batch(spark, str(place / "logs"), str(place / "songs"), str(place / "out"))


def table(spark, place, name):
    return publish.read_published(spark, str(place / "out"), name, MUSIC_MODEL[name])


def plays(spark, place, rows):
    return rows(table(spark, place, "songplays").select("user_id", "session_id", "song_id"))


def test_new_files_only(spark, place, rows):
    assert len(run(spark, place)) == 2
    first = [(4, 10, None), (8, None, "S1"), (8, 10, "S1")]
    assert plays(spark, place, rows) == first
    # an idle run needs none of the rows loaded before
    before = publish.current(spark, str(place / "out"))
    (place / "out" / "data").rename(place / "away")
    assert run(spark, place) == []
    (place / "away").rename(place / "out" / "data")
    assert publish.current(spark, str(place / "out")) == before
    # plays that come again in another file, without a session too, are the same plays
    write(place / "logs", "2.json", [
        {**EVENT, "sessionId": None, "itemInSession": 2}, EVENT, {**EVENT, "ts": EVENT["ts"] + 1}, EVENT,
    ])
    assert len(run(spark, place)) == 1
    assert plays(spark, place, rows) == [*first, (8, 10, "S1")]
    assert rows(table(spark, place, "users").select("user_id")) == [(4,), (8,)]
    assert table(spark, place, "time").count() == 2


def test_a_repeated_batch_is_published_once(spark, place, rows):
    run(spark, place)
    out = place / "out"
    manifest = publish.current(spark, str(out))
    for stream in ("songs", "events"):
        for file in (out / "streams" / stream / "commits").iterdir():
            file.unlink()
    assert run(spark, place) == []
    assert publish.current(spark, str(out)) == manifest
    assert len(plays(spark, place, rows)) == 3


def test_a_failed_batch_changes_nothing_until_it_is_mended(spark, place, rows):
    run(spark, place)
    manifest, before = publish.current(spark, str(place / "out")), plays(spark, place, rows)
    write(place / "logs", "2.json", [{**EVENT, "userId": "", "ts": EVENT["ts"] + 7}])
    write(place / "songs", "2.json", [{**SONG, "song_id": "S2"}])
    for _ in range(2):
        with pytest.raises(DataQualityError, match=r"songplays: not_null\(user_id\) failed for 1 of 1 rows"):
            run(spark, place)
        after = publish.current(spark, str(place / "out"))
        assert {k: v for k, v in after.folders.items() if "song" not in k and k != "artists"} == {
            k: v for k, v in manifest.folders.items() if "song" not in k and k != "artists"
        }
        assert after.batches == {**manifest.batches, "songs": 1}
        assert plays(spark, place, rows) == before
    write(place / "logs", "2.json", [{**EVENT, "userId": "30", "ts": EVENT["ts"] + 7}])
    run(spark, place)
    assert plays(spark, place, rows) == sorted([*before, (30, 10, "S1")], key=lambda r: [(v is not None, str(v)) for v in r])


def test_publishing(spark, tmp_path, rows):
    root, schema = str(tmp_path / "set"), MUSIC_MODEL["users"]
    assert publish.current(spark, root) == publish.Manifest()
    assert publish.read_published(spark, root, "users", schema).collect() == []
    user = "user_id int, first_name string, last_name string, gender string, level string"
    manifest = publish.current(spark, root)
    for batch, key in enumerate((1, 2, 3)):
        new = spark.createDataFrame([(key, "a", "b", "F", "free")], user)
        pending = publish.write_pending(new, root, "users", schema, "s", batch)
        manifest, _ = publish.publish_batch(spark, root, manifest, "s", batch, {"users": pending}, [CheckSpec("users")])
    assert publish.current(spark, root) == manifest
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):  # another publisher came first
        publish.publish_batch(spark, root, publish.Manifest(), "s", 9, {})
    publish.compact(spark, root, "users", schema)
    assert len(publish.current(spark, root).folders["users"]) == 1
    publish.register_views(spark, root, {"users": schema}, "published_")
    assert rows(spark.sql("SELECT user_id FROM published_users")) == [(1,), (2,), (3,)]


def test_all_checks_of_a_table_take_one_scan(spark, tmp_path, plan):
    path, parent = str(tmp_path / "t"), str(tmp_path / "p")
    spark.range(100).selectExpr("id AS a", "id % 7 AS b", "CAST(id AS string) AS c", "id % 3 AS d").write.parquet(path)
    spark.range(2).write.parquet(parent)
    spec = CheckSpec("t", not_null=["a", "b", "c"], unique=[["a"], ["b", "c"]], references=[("d", "p", "id")])
    report = check_table(spark.read.parquet(path), spec, {"p": spark.read.parquet(parent)})
    found = {(r["check_name"], r["column_name"]): (r["row_count"], r["failed_count"], r["passed"]) for r in report.collect()}
    assert found == {
        ("not_empty", ""): (100, 0, True), ("not_null", "a"): (100, 0, True), ("not_null", "b"): (100, 0, True),
        ("not_null", "c"): (100, 0, True), ("unique", "a"): (100, 0, True), ("unique", "b,c"): (100, 0, True),
        ("references", "d"): (100, 33, False),
    }
    text = plan(report)
    final = text[text.index("Final Plan") : text.index("Initial Plan")] if "Initial Plan" in text else text
    assert final.count("FileScan") == 2  # the table and its parent
    assert "Join" not in final


def test_one_scan_checks_equal_the_single_ones(spark):
    rows = [(1, None, 1.5, b"\xff"), (1, "x", 1.5, b"\xfe"), (None, "", -0.0, None), (None, "", 0.0, None), (2, "null", None, b"")]
    df = spark.createDataFrame(rows, "k int, s string, d double, b binary")
    parent = spark.createDataFrame([(1,), (1,), (None,), (5,)], "k int").withColumn("k", F.col("k").cast("decimal(9,2)"))
    spec = CheckSpec("t", ["k", "s"], [["k"], ["s"], ["k", "s"], ["b"]], [("k", "p", "k")])
    report = run_checks(spark, [spec], fail=False, tables={"t": df, "p": parent})
    failed = {(r["check_name"], r["column_name"]): r["failed_count"] for r in report.collect()}
    assert failed == {
        ("not_empty", ""): 0, ("not_null", "k"): 2, ("not_null", "s"): 1, ("unique", "k"): 2, ("unique", "s"): 1,
        ("unique", "k,s"): 1, ("unique", "b"): 1, ("references", "k"): 1,
    }
    none = run_checks(spark, [CheckSpec("t", ["k"], [["k"]], [("k", "p", "k")])], False, {"t": df.limit(0), "p": parent})
    assert [(r["row_count"], r["failed_count"], r["passed"]) for r in none.collect()] == [
        (0, 0, False), (0, 0, True), (0, 0, True), (0, 0, True),
    ]


def test_the_odd_log_takes_one_scan_of_the_events(spark, tmp_path, plan):
    kinds, users = ("purchase", "error", "view"), (1, 3, 4, 5, 13, 33, None)
    events = [
        (i, datetime(2024, 1, 1 + i % 3, i % 24), users[i % 7], kinds[i % 3], i % 40 * 1.0, f'{{"k": {i % 5}}}')
        for i in range(60)
    ]
    events += events[:9]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    parts = [(i, f"N{i}", "B", "T", 1, 2.0) for i in range(4)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    log = inputs.events(spark, str(tmp_path))
    more = log.where("userId % 4 = 1").withColumn("itemInSession", F.col("itemInSession") + 100)
    wanted = log.unionByName(more).withColumn("sessionId", F.when(F.col("userId") % 10 != 3, F.col("sessionId")))
    odd = refresh._odd_log(spark, str(tmp_path))
    # the events and the parts, each once
    assert plan(odd).count("FileScan") == 2
    assert odd.dtypes == wanted.dtypes
    assert sorted(odd.collect(), key=str) == sorted(wanted.collect(), key=str)
