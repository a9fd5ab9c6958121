import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import any_key_join, hot_keys, insert_new, skew_join

KEY = st.one_of(st.none(), st.integers(0, 4))
PROPERTY = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, rows, how):
    left = spark.createDataFrame(
        [(1, i % 3) for i in range(200)] + [(None, i) for i in range(50)] + [(k, k) for k in range(20)],
        "k int, v int",
    )
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (99, "e")], "k int, w string")
    assert rows(skew_join(left, right, ["k"], how, hot_keys(left, ["k"], 0.1), salts=8)) == rows(
        left.join(right, ["k"], how)
    )


def test_skew_join_spreads_copies_of_one_row(spark):
    left = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(1, "a")], "k int, w string")
    from starloom.operators.joins import row_spread

    buckets = left.select(row_spread(left, 16).alias("b")).distinct().count()
    assert buckets > 1
    assert skew_join(left, right, ["k"], hot=hot_keys(left, ["k"])).count() == 4000


def test_skew_join_leaves_even_keys_alone(spark, plan):
    left, right = spark.range(1000).toDF("k"), spark.range(10).toDF("k")
    assert "_salt" not in plan(skew_join(left, right, ["k"]))
    assert "_salt" in plan(skew_join(left, right, ["k"], hot=hot_keys(left, ["k"], 0.0001)))
    assert hot_keys(left, ["k"], 0.01).isEmpty()


def test_skew_join_rejects_right_outer(spark):
    df = spark.range(1).toDF("k")
    with pytest.raises(ValueError):
        skew_join(df, df, ["k"], "right")


@PROPERTY
@given(st.lists(st.tuples(KEY, KEY), max_size=12), st.lists(KEY, max_size=6))
def test_any_key_join_equals_or_join(spark, rows, left_rows, right_rows):
    left = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left_rows)], "id int, a int, b int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(right_rows)], "k int, n int")
    expected = left.join(right, (F.col("a") == F.col("k")) | (F.col("b") == F.col("k"))).select("id", "k", "n")
    for hot in (None, left.select(F.col("a").alias("k")).distinct()):
        got = any_key_join(left, right, ["a", "b"], "k", hot)
        assert rows(got.select("id", "k", "n")) == rows(expected)


@PROPERTY
@given(st.lists(KEY, max_size=8), st.lists(KEY, max_size=5))
def test_null_aware_insert_equals_not_in(spark, rows, incoming, target):
    spark.createDataFrame([(i, k) for i, k in enumerate(incoming)], "n int, k int").createOrReplaceTempView("inc")
    spark.createDataFrame([(k,) for k in target], "k int").createOrReplaceTempView("tgt")
    expected = spark.sql("SELECT * FROM inc WHERE k NOT IN (SELECT k FROM tgt)")
    got = insert_new(spark.table("inc"), spark.table("tgt"), ["k"], null_aware=True)
    assert rows(got) == rows(expected)


def test_insert_new_plain_keeps_null_keys(spark, rows):
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    target = spark.createDataFrame([(1,)], "k int")
    assert rows(insert_new(incoming, target, ["k"])) == [(None, "c"), (2, "b")]
    assert rows(insert_new(incoming, target, ["k"], null_aware=True)) == [(2, "b")]


def test_insert_new_on_two_keys(spark, rows):
    incoming = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "u int, s int")
    target = spark.createDataFrame([(1, 2, "x")], "u int, s int, z string")
    assert rows(insert_new(incoming, target, ["u", "s"])) == [(1, 1), (2, 1)]
    with pytest.raises(ValueError):
        insert_new(incoming, target, ["u", "s"], null_aware=True)
