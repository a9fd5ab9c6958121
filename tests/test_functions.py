import datetime as dt

from pyspark.sql import functions as F

from starloom import functions as fn


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def test_date_key(spark):
    assert one(spark, fn.date_key(F.lit("2016-07-10").cast("date"))) == 20160710
    assert one(spark, fn.date_key(F.lit("2041-05-18 23:59:59").cast("timestamp"))) == 20410518


def test_epoch_whole_seconds_and_fraction(spark):
    whole = one(spark, fn.epoch_ms_to_timestamp(F.lit(1541121934796)).cast("string"))
    exact = one(spark, fn.epoch_ms_to_timestamp(F.lit(1541121934796), False).cast("string"))
    assert whole == "2018-11-02 01:25:34"
    assert exact == "2018-11-02 01:25:34.796"
    assert one(spark, fn.timestamp_to_epoch_ms(F.lit(exact).cast("timestamp"))) == 1541121934796


def test_calendar_parts_iso_week_and_weekday_base(spark):
    day = F.lit("2016-01-03 05:00:00").cast("timestamp")  # a Sunday in ISO week 53 of 2015
    parts = fn.calendar_parts(day)
    got = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert got == {"hour": 5, "day": 3, "week": 53, "month": 1, "year": 2016, "weekday": 0}
    assert one(spark, fn.calendar_parts(day, 1)["weekday"]) == 1


def test_lenient_cast(spark):
    def cast(text, kind):
        return one(spark, fn.lenient_cast(F.lit(text), kind))

    assert cast("1.54111E+12", "bigint") == 1541110000000
    assert cast("12", "int") == 12
    assert cast("1.0", "int") == 1
    assert cast("abc", "int") is None
    assert cast(".50", "double") == 0.5
    assert cast("abc", "date") is None
    assert str(cast("8.16", "decimal(18,2)")) == "8.16"


def test_cast_columns_and_unknown(spark):
    df = spark.createDataFrame([("1", "x"), (None, "y"), ("q", "z")], "a string, b string")
    got = fn.cast_columns(df, {"a": "int"}).select(fn.fill_unknown(F.col("a")), "b").collect()
    assert [tuple(r) for r in got] == [(1, "x"), (-1, "y"), (-1, "z")]


def test_label_array_uppercases_and_drops_nulls(spark):
    df = spark.createDataFrame([("Taxi", None, "TAXI", "Bus")], "a string, b string, c string, d string")
    assert df.select(fn.label_array(list("abcd"))).first()[0] == ["TAXI", "BUS"]
    assert df.select(fn.label_array(list("abcd"), upper=False)).first()[0] == ["Taxi", "TAXI", "Bus"]


def test_flag_labels(spark):
    df = spark.createDataFrame([(1, 0), (0, None)], "a int, b int")
    flags = fn.flag_labels({"A": F.col("a") > 0, "B": F.col("b") > 0})
    assert [r[0] for r in df.select(flags).collect()] == [["A"], []]


def test_hash_key_is_md5_of_text(spark):
    import hashlib

    start = dt.datetime(2018, 11, 2, 1, 25, 34)
    df = spark.createDataFrame([(139, str(start))], "s int, t string").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    expected = hashlib.md5(b"1392018-11-02 01:25:34").hexdigest()
    assert df.select(fn.hash_key(F.col("s"), F.col("t"))).first()[0] == expected
    assert one(spark, fn.hash_key(F.lit(1), F.lit(None))) is None
    assert one(spark, fn.hash_key(F.lit("a"), F.lit("b"), separator="|")) == hashlib.md5(b"a|b").hexdigest()
