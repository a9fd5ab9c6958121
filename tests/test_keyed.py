import pytest
from pyspark.sql import functions as F

from starloom.operators import dedupe_by_key, dense_id, keyed_table, lookup, row_id, top_k, top_n_per_group, upsert
from starloom.operators.keyed import cluster_for_lookup


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [(1, 10, "a"), (1, 30, "c"), (1, 20, "b"), (2, 5, "x"), (2, 5, "y"), (None, 1, "n")],
        "k int, ts int, v string",
    )


def test_keyed_table_last_write_wins(log, rows):
    assert rows(keyed_table(log, ["k"], ["ts", "v"])) == [(None, 1, "n"), (1, 30, "c"), (2, 5, "y")]
    assert rows(keyed_table(log, ["k"], ["ts", "v"], ["v"])) == [("c",), ("n",), ("y",)]


def test_dedupe_keeps_first(log, rows):
    assert rows(dedupe_by_key(log, ["k"], ["ts", "v"])) == [(None, 1, "n"), (1, 10, "a"), (2, 5, "x")]


def test_dedupe_limits_each_key_before_the_shuffle(log, plan):
    text = plan(dedupe_by_key(log, ["k"], ["ts", "v"]))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text


def test_upsert_incoming_wins(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    incoming = spark.createDataFrame([(2, "n1", 1), (2, "n2", 2), (3, "n3", 1)], "k int, v string, ts int")
    assert rows(upsert(target, incoming, ["k"], ["ts"])) == [(1, "old"), (2, "n2"), (3, "n3")]
    once = incoming.where("ts = 2").select("v", "k")
    assert rows(upsert(target, once, ["k"])) == [(1, "old"), (2, "n2")]


def test_lookup(log, rows):
    assert [r["v"] for r in lookup(log, order_by=["ts"], k=1).collect()] == ["a", "b", "c"]
    assert rows(lookup(log, k=1, ts=20)) == [(1, 20, "b")]


def test_cluster_for_lookup_keeps_rows(log, rows):
    assert rows(cluster_for_lookup(log, ["k"], ["ts"])) == rows(log)


def test_dense_id_is_consecutive_in_order(spark):
    shuffled = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = dense_id(shuffled, ["v"], start=5)
    assert got.where(F.col("id") != F.col("v") + 5).count() == 0
    assert got.count() == 1000


def test_dense_id_empty(spark):
    assert dense_id(spark.range(0), ["id"], "n").count() == 0


def test_row_id_unique(spark):
    assert row_id(spark.range(0, 500, 1, 5), "n").select("n").distinct().count() == 500


def test_rank_ties_share_a_rank(spark, rows):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", 5), ("g", "c", 4), ("h", "a", 1)], "g string, f string, n int")
    got = rows(top_n_per_group(df, ["g"], "n", 2).select("g", "f", "rank"))
    assert got == [("g", "a", 1), ("g", "b", 1), ("h", "a", 1)]


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "t string, n int")
    assert [r["t"] for r in top_k(df, "n", 2, ["t"]).collect()] == ["c", "a"]
