"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.base import Registry, table
from starloom.functions.arrays import label_array
from starloom.operators.aggregates import count_elements, duplicate_keys, global_count
from starloom.operators.quality import (
    CheckSpec,
    casing_variants,
    check_references,
    check_unique,
    numeric_labels,
    profile_nulls,
    require,
    run_checks,
)

QUERIES = Registry()

_REPORT = "row_count, failed_count, passed"


@QUERIES.add(f"""
WITH o AS (SELECT count(*) AS n, count_if(o_totalprice IS NULL) AS price,
                  count_if(nullif(o_orderstatus, 'P') IS NULL) AS status FROM orders),
     d AS (SELECT count(*) AS twice FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)),
     r AS (SELECT count(*) AS orphans FROM orders ANTI JOIN customer ON o_custkey = c_custkey
           WHERE o_custkey IS NOT NULL),
     c AS (SELECT count(*) AS n, count_if(c_name IS NULL) AS name FROM customer)
SELECT 'checked_orders' AS table_name, 'not_empty' AS check_name, '' AS column_name,
       n AS row_count, 0 AS failed_count, n > 0 AS passed FROM o
UNION ALL SELECT 'checked_orders', 'not_null', 'o_totalprice', n, price, price = 0 FROM o
UNION ALL SELECT 'checked_orders', 'not_null', 'status', n, status, status = 0 FROM o
UNION ALL SELECT 'checked_orders', 'unique', 'o_orderkey', n,
                 twice, twice = 0 FROM o, d
UNION ALL SELECT 'checked_orders', 'references', 'o_custkey', n,
                 orphans, orphans = 0 FROM o, r
UNION ALL SELECT 'checked_customer', 'not_empty', '', n, 0, n > 0 FROM c
UNION ALL SELECT 'checked_customer', 'not_null', 'c_name', n, name, name = 0 FROM c
""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table-driven checks on two tables, one of which has NULLs."""
    table(spark, sf_dir, "orders").withColumn(
        "status", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    ).createOrReplaceTempView("checked_orders")
    table(spark, sf_dir, "customer").createOrReplaceTempView("checked_customer")
    return run_checks(
        spark,
        [
            CheckSpec(
                "checked_orders",
                not_null=["o_totalprice", "status"],
                unique=[["o_orderkey"]],
                references=[("o_custkey", "checked_customer", "c_custkey")],
            ),
            {"table_name": "checked_customer", "not_null": "c_name"},
        ],
        fail=False,
    )


@QUERIES.add("""
SELECT l_orderkey, l_partkey, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@QUERIES.add("""
WITH k AS (SELECT count(*) AS n FROM part GROUP BY p_name, p_brand)
SELECT 'part' AS table_name, 'unique' AS check_name, 'p_name,p_brand' AS column_name,
       CAST(sum(n) AS BIGINT) AS row_count, count_if(n > 1) AS failed_count,
       count_if(n > 1) = 0 AS passed FROM k
""")
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(table(spark, sf_dir, "part"), "part", ["p_name", "p_brand"])


@QUERIES.add("""
SELECT 'events' AS table_name, 'references' AS check_name, 'user_id' AS column_name,
       count(*) AS row_count,
       count_if(user_id NOT IN (SELECT s_suppkey FROM supplier)) AS failed_count,
       count_if(user_id NOT IN (SELECT s_suppkey FROM supplier)) = 0 AS passed
FROM events
""")
def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_references(
        table(spark, sf_dir, "events"), "events", "user_id", table(spark, sf_dir, "supplier"), "s_suppkey"
    )


def _labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event type in three spellings and the number in props."""
    return (
        table(spark, sf_dir, "events")
        .select(
            F.when(F.col("value") < 10, F.upper("event_type"))
            .when(F.col("value") < 20, F.initcap("event_type"))
            .otherwise(F.col("event_type"))
            .alias("a"),
            F.get_json_object("props", "$.k").alias("b"),
            F.nullif(F.col("event_type"), F.lit("view")).alias("c"),
        )
        .select(label_array(["a", "b", "c"], upper=False).alias("labels"))
    )


_LABELS_SQL = """
labelled AS (
  SELECT unnest(list_distinct([
    CASE WHEN value < 10 THEN upper(event_type)
         WHEN value < 20 THEN upper(event_type[1]) || event_type[2:] ELSE event_type END,
    json_extract_string(props, '$.k'), nullif(event_type, 'view')])) AS label
  FROM events
)"""


@QUERIES.add(f"""
WITH {_LABELS_SQL}
SELECT DISTINCT label FROM labelled WHERE regexp_matches(label, '(?i)^purchase$')
""")
def casing_variants_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casing_variants(_labelled_events(spark, sf_dir), "labels", "^purchase$")


@QUERIES.add(f"""
WITH {_LABELS_SQL}
SELECT DISTINCT label, CAST(try_cast(label AS INTEGER) AS BIGINT) AS number FROM labelled
WHERE try_cast(label AS INTEGER) > 0
""")
def numeric_labels_in_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_labels(_labelled_events(spark, sf_dir), "labels")


@QUERIES.add(f"WITH {_LABELS_SQL} SELECT label, count(*) AS event_count FROM labelled GROUP BY ALL")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_elements(_labelled_events(spark, sf_dir), "labels", [], "label", "event_count")


_GAPS_SQL = """
gaps AS (
  SELECT event_id, nullif(event_type, 'error') AS kind, nullif(user_id, 7) AS who,
         CASE WHEN value < 50 THEN value END AS amount
  FROM events
)"""


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("event_type"), F.lit("error")).alias("kind"),
        F.nullif(F.col("user_id"), F.lit(7)).alias("who"),
        F.when(F.col("value") < 50, F.col("value")).alias("amount"),
    )


@QUERIES.add(f"""
WITH {_GAPS_SQL}
SELECT count(*) AS row_count,
       count_if(kind IS NULL OR who IS NULL OR amount IS NULL) AS corrupt_count,
       count_if(kind IS NULL) AS null_kind, count_if(who IS NULL) AS null_who,
       count_if(amount IS NULL) AS null_amount
FROM gaps
""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_nulls(_events_with_gaps(spark, sf_dir), ["kind", "who", "amount"])


@QUERIES.add(f"""
WITH {_GAPS_SQL}
SELECT event_id FROM gaps WHERE kind IS NOT NULL AND (who IS NOT NULL OR amount IS NOT NULL)
""")
def required_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require(_events_with_gaps(spark, sf_dir), ["kind"], ["who", "amount"]).select("event_id")


@QUERIES.add("""
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part
""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "events", "lineitem", "orders", "part"]
    counts = [
        global_count(table(spark, sf_dir, n)).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
