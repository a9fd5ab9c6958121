import pytest
from pyspark.sql import functions as F

from starloom.operators import (
    DataQualityError,
    casing_variants,
    collect_distinct_elements,
    count_elements,
    duplicate_keys,
    numeric_labels,
    profile_nulls,
    require,
    run_checks,
)
from starloom.operators.quality import CheckSpec, check_references, check_unique


def test_collect_distinct_elements(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", ["x", None, "y"], ["q"], 1),
            ("a", ["y", "y"], None, 2),
            ("b", None, [], None),
            (None, ["z"], ["z"], 4),
        ],
        "g string, l1 array<string>, l2 array<string>, m int",
    )
    got = collect_distinct_elements(df, ["g"], {"o1": "l1", "o2": "l2"}, {"n": F.lit(1), "m": F.col("m")})
    assert rows(got) == [
        (None, 1, 4, ["z"], ["z"]),
        ("a", 2, 3, ["x", "y"], ["q"]),
        ("b", 1, None, [], []),
    ]


def test_collect_distinct_matches_plain_form_with_a_hot_group(spark, rows):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        F.array((F.col("id") % 11).cast("string"), F.lit(None), (F.col("id") % 7).cast("string")).alias("l"),
    )
    plain = df.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.array_compact("l"))))).alias("o"),
    )
    assert rows(collect_distinct_elements(df, ["g"], {"o": "l"}, {"n": F.lit(1)})) == rows(plain)


def test_count_elements_skips_null_and_empty(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["a"]), (2, []), (3, None)], "k int, l array<string>")
    assert rows(count_elements(df, "l", ["k"], "e", "n")) == [(1, "a", 2), (1, "b", 1)]


def test_duplicate_keys_counts_nulls_as_equal(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(duplicate_keys(df, ["k"])) == [(None, 2), (1, 2)]


def test_require_all_and_any(spark, rows):
    df = spark.createDataFrame([(1, 1, None), (1, None, None), (None, 1, 1)], "d int, x int, y int")
    assert rows(require(df, ["d"], ["x", "y"])) == [(1, 1, None)]
    assert rows(require(df, ["d", "x", "y"])) == []


def test_profile_nulls(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, 3)], "a int, b int")
    assert rows(profile_nulls(df, ["a", "b"])) == [(3, 2, 1, 2)]


def test_label_profiles(spark, rows):
    df = spark.createDataFrame([(["Taxi", "80", "x"],), (["TAXI", "1", "-3"],), (["taxis", "taxi", "80"],)], "l array<string>")
    assert rows(casing_variants(df, "l", "^taxi$")) == [("TAXI",), ("Taxi",), ("taxi",)]
    assert rows(numeric_labels(df, "l")) == [("1", 1), ("80", 80)]


def test_run_checks_passes_and_reports(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("good")
    report = run_checks(spark, [{"table_name": "good", "not_null": "v"}])
    assert [(r["check_name"], r["passed"]) for r in report.collect()] == [("not_empty", True), ("not_null", True)]


def test_run_checks_fails_with_counts(spark):
    spark.createDataFrame([(1, None), (1, "b")], "k int, v string").createOrReplaceTempView("bad")
    spark.createDataFrame([], "k int").createOrReplaceTempView("empty_table")
    with pytest.raises(DataQualityError, match=r"bad: not_null\(v\) failed for 1 of 2 rows"):
        run_checks(spark, [CheckSpec("bad", not_null=["v"])])
    with pytest.raises(DataQualityError, match="empty_table: not_empty"):
        run_checks(spark, [CheckSpec("empty_table")])
    report = run_checks(spark, [CheckSpec("bad", unique=[["k"]], references=[("k", "empty_table", "k")])], fail=False)
    failed = {r["check_name"]: r["failed_count"] for r in report.collect() if not r["passed"]}
    assert failed == {"unique": 1, "references": 2}


def test_checks_on_empty_and_null(spark):
    empty = spark.createDataFrame([], "k int")
    assert check_unique(empty, "e", ["k"]).first()["row_count"] == 0
    nulls = spark.createDataFrame([(None,), (1,)], "k int")
    assert check_references(nulls, "n", "k", spark.createDataFrame([(1,)], "k int"), "k").first()["failed_count"] == 0
