"""Sources and sinks: write the tables out, read them back, compare with the original.

Every run writes to new folders on the shared storage named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.catalog import inputs
from starloom.catalog.base import Registry, table
from starloom.operators.keyed import cluster_for_lookup, lookup
from starloom.operators.sinks import (
    append_table,
    create_bucketed,
    insert_new_bucketed,
    insert_new_rows,
    load_dimension,
    load_fact,
    materialize,
    overwrite_table,
    stage_table,
    upsert_buckets,
    upsert_table,
    write_csv_quoted,
    write_parquet,
)
from starloom.operators.ranking import preview
from starloom.operators.spatial import locate_points
from starloom.operators.surrogate import append_with_identity
from starloom.plans import city, music
from starloom.plans.model import create_model, data_dictionary
from starloom.schemas import LOOKUP_MODEL, PLAY_LOG_COLUMNS, STAGING_EVENTS
from starloom.session import work_path
from starloom.sources.files import merge_csv, read_csv_strings, read_json, read_parquet, read_table
from starloom.sources.geo import read_zone_polygons
from starloom.sources.staging import read_json_paths, stage_json, stage_json_text
from starloom.streaming.incremental import stage_incremental

QUERIES = Registry()

_LOG_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "page", "sessionId", "song", "ts", "userAgent", "userId",
]
_LOG_SQL = ", ".join(
    f'CAST("{c}" AS BIGINT) AS "{c}"' if c in ("itemInSession", "sessionId", "userId", "ts") else f'"{c}"'
    for c in _LOG_COLUMNS
)


# tables of the queries live in a database of their own
_DATABASE = "starloom_queries"


def _temporary_table(spark: SparkSession, name: str, schema: T.StructType) -> str:
    """A new external table on the shared storage under a fixed name."""
    return create_model(
        spark, {name: schema}, _DATABASE, recreate=True, location=work_path(spark, name)
    )[0]


# ---- JSON ------------------------------------------------------------------------

_PROPS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType())])


@QUERIES.add("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def json_path_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns picked from nested JSON text by path."""
    text = table(spark, sf_dir, "events").select(
        F.concat(
            F.lit('{"id": '), F.col("event_id"), F.lit(', "detail": '), F.col("props"), F.lit("}")
        ).alias("line")
    )
    return stage_json_text(text, "line", _PROPS, {"event_id": "$['id']", "k": "$.detail.k"})


@QUERIES.add(f"WITH {inputs.EVENTS_SQL} SELECT {_LOG_SQL} FROM log")
def json_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written as JSON lines into nested folders and read with its schema."""
    path = work_path(spark, "json_log")
    log = inputs.events(spark, sf_dir)
    log.withColumns({"p": F.col("level"), "q": F.col("gender")}).write.partitionBy("p", "q").json(path)
    return read_json(spark, f"{path}/*/*/*.json", STAGING_EVENTS).select(*_LOG_COLUMNS)


@QUERIES.add(f"WITH {inputs.EVENTS_SQL} SELECT {_LOG_SQL} FROM log")
def json_auto_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON fields matched to the staging columns by name in any letter case."""
    path = work_path(spark, "json_stage")
    log = inputs.events(spark, sf_dir)
    log.select(*[F.col(c).alias(c.upper()) for c in log.columns]).write.json(path)
    return stage_json(spark, path, STAGING_EVENTS).select(*_LOG_COLUMNS)


@QUERIES.add(f"WITH {inputs.EVENTS_SQL} SELECT {_LOG_SQL} FROM log")
def stage_incremental_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files staged by a stream that runs three times: each file is loaded once."""
    source, target = work_path(spark, "incoming"), work_path(spark, "staged")
    checkpoint = work_path(spark, "stage_checkpoint")
    log = inputs.events(spark, sf_dir)
    log.where(F.col("level") == "paid").write.json(source)
    stage_incremental(spark, source, STAGING_EVENTS, target, checkpoint)
    log.where(F.col("level") == "free").write.mode("append").json(source)
    stage_incremental(spark, source, STAGING_EVENTS, target, checkpoint)
    stage_incremental(spark, source, STAGING_EVENTS, target, checkpoint)
    return read_parquet(spark, target).select(*_LOG_COLUMNS)


# ---- CSV -------------------------------------------------------------------------


@QUERIES.add("""
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, nullif(o_orderstatus, 'P') AS o_orderstatus
FROM orders
""")
def csv_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of quoted CSV files, each with its header, read as one typed dataset."""
    path = work_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    write_csv_quoted(orders.hint("rebalance"), path)
    return merge_csv(spark, path, _ORDERS)


_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@QUERIES.add("""
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderstatus || chr(10) || '"' || o_orderpriority || '", ' || o_orderkey AS o_orderstatus
FROM orders
""")
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts, with quotes, commas and line breaks inside fields."""
    path = work_path(spark, "csv_mixed")
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus",
        F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('", '), "o_orderkey"),
    )
    turned = list(reversed(orders.columns))
    write_csv_quoted(orders.where("o_totalprice < 100000"), path)
    write_csv_quoted(orders.where("o_totalprice >= 100000"), path, turned, mode="append")
    return merge_csv(spark, path, _ORDERS)



@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT {", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in PLAY_LOG_COLUMNS if c != "length")}, length
FROM log WHERE artist <> ''
""")
def csv_play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play rows written as the quoted play log and read back as text."""
    path = work_path(spark, "play_log")
    write_csv_quoted(music.play_rows(inputs.events(spark, sf_dir)), path, PLAY_LOG_COLUMNS)
    return read_csv_strings(spark, path).withColumn("length", F.col("length").cast("double"))


@QUERIES.add(f"WITH {inputs.TRIPS_SQL} SELECT * FROM trip_fact")
def csv_trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as CSV text, read through a file-name pattern and rolled up."""
    path = work_path(spark, "trips")
    inputs.raw_trips(spark, sf_dir).write.option("header", "true").csv(path)
    return city.trip_fact(city.clean_trips(read_csv_strings(spark, f"{path}/part-*.csv", multi_line=False)))


# ---- GeoJSON ---------------------------------------------------------------------


def zone_document(zones: DataFrame) -> DataFrame:
    """Zones as one FeatureCollection; 25 of them, so one row holds it."""
    corner = lambda e: F.array(e["x1"], e["y1"])
    ring = F.transform("edges", corner)
    closed = F.concat(ring, F.slice(ring, 1, 1))
    many = F.col("ord") % 2 == 1
    feature = F.struct(
        F.col("ord"),
        F.concat(
            F.lit('{"type":"Feature","geometry":{"type":"'),
            F.when(many, "MultiPolygon").otherwise("Polygon"),
            F.lit('","coordinates":'),
            F.when(many, F.to_json(F.array(F.array(closed)))).otherwise(F.to_json(F.array(closed))),
            F.lit('},"properties":'),
            F.to_json(
                F.struct(F.col("location_id").cast("string").alias("location_id"), "zone", "borough")
            ),
            F.lit("}"),
        ).alias("text"),
    )
    return zones.agg(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.array_join(F.transform(F.sort_array(F.collect_list(feature)), lambda f: f["text"]), ","),
            F.lit("]}"),
        ).alias("value")
    )


@QUERIES.add(f"""
WITH {inputs.AREAS_SQL}
SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS zone, r_name AS borough, count(*) AS events
FROM points
LEFT JOIN nation ON x > n_nationkey % 5 * 20 AND x < n_nationkey % 5 * 20 + 20
                AND y > n_nationkey // 5 * 20 AND y < n_nationkey // 5 * 20 + 20
LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL
""")
def geojson_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per zone, the zones read from a GeoJSON FeatureCollection."""
    path = work_path(spark, "geojson")
    zone_document(inputs.zone_polygons(spark, sf_dir)).write.text(path)
    zones = read_zone_polygons(spark, path)
    return (
        locate_points(inputs.event_points(spark, sf_dir), zones, "x", "y", alias="z")
        .groupBy("z.location_id", "z.zone", "z.borough")
        .agg(F.count(F.lit(1)).alias("events"))
    )


# ---- Parquet and tables ------------------------------------------------------------


@QUERIES.add("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE l_returnflag = 'R'
""")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in folders per flag and status; the filter reads only one flag's folders."""
    path = work_path(spark, "partitioned")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    write_parquet(rows, path, ["l_returnflag", "l_linestatus"], sort_within=["l_orderkey"])
    return read_parquet(spark, path).where(F.col("l_returnflag") == "R")


@QUERIES.add("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS version, o_orderstatus
FROM orders
""")
def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh of one partition leaves the other folders as they are."""
    path = work_path(spark, "dynamic")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_parquet(orders.withColumn("version", F.lit("old")), path, ["o_orderstatus"])
    changed = orders.where(F.col("o_orderstatus") == "F").withColumn("version", F.lit("new"))
    write_parquet(changed, path, ["o_orderstatus"], dynamic=True)
    return read_parquet(spark, path)


@QUERIES.add("SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL")
def materialize_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the stored table and ignores its own input."""
    name = f"{_DATABASE}.materialized_orders"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_DATABASE}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = work_path(spark, "materialized")
    materialize(orders, name, path=path)
    stored = materialize(orders.where("false"), name, reuse=True, path=path)
    return stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


_ACCOUNTS = T.StructType(
    [
        T.StructField("account", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("balance", T.DecimalType(18, 2)),
    ]
)


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, columns in another order and of other types than the table's."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("BALANCE"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").cast("string").alias("account"),
    )


@QUERIES.add("""
SELECT c_custkey AS account, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS balance,
       2 AS copies
FROM customer
""")
def table_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, append, truncate and insert on one table: two copies remain."""
    name = _temporary_table(spark, "accounts", _ACCOUNTS)
    rows = _accounts(spark, sf_dir)
    append_table(rows, name)
    overwrite_table(rows, name)
    load_fact(rows, name)
    load_dimension(rows, name, "truncate")
    load_dimension(rows, name, "insert")
    return (
        read_table(spark, name)
        .groupBy("account", "name", "balance")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@QUERIES.add("""
SELECT c_custkey AS account, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS balance
FROM customer
""")
def insert_new_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the AUTOMOBILE segment first, then all twice: nothing is doubled."""
    name = _temporary_table(spark, "new_accounts", _ACCOUNTS)
    rows = _accounts(spark, sf_dir)
    segment = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    first = rows.join(segment.select(F.col("c_custkey").cast("string").alias("account")), "account")
    insert_new_rows(first, name, ["account"])
    insert_new_rows(rows, name, ["account"], null_aware=True)
    insert_new_rows(rows, name, ["account"])
    return read_table(spark, name)


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT song, "userId", "firstName", "lastName" FROM log WHERE artist <> ''
QUALIFY 1 = row_number() OVER (PARTITION BY song, "userId" ORDER BY ts DESC, "firstName" DESC, "lastName" DESC)
""")
def upsert_listen_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listen history filled by two upserts of overlapping rows."""
    name = _temporary_table(spark, "song_listen_history", LOOKUP_MODEL["song_listen_history"])
    played = music.play_rows(inputs.events(spark, sf_dir)).select(
        "song", "userId", "firstName", "lastName", "ts", "level"
    )
    upsert_table(played.where(F.col("level") == "free").drop("level"), name, ["song", "userId"], ["ts"])
    upsert_table(played.drop("level"), name, ["song", "userId"], ["ts"])
    return read_table(spark, name)


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL},
latest AS (
  SELECT "userId", "sessionId", "itemInSession", artist, song FROM log WHERE artist <> ''
  QUALIFY 1 = row_number() OVER (
    PARTITION BY "userId", "sessionId", "itemInSession"
    ORDER BY ts DESC, artist DESC, song DESC, "firstName" DESC, "lastName" DESC)
)
SELECT CAST("itemInSession" AS BIGINT) AS "itemInSession", artist, song FROM latest
WHERE "userId" = 10 AND "sessionId" = 1018
""")
def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The songs-per-session table stored in key order; the lookup skips other key ranges."""
    path = work_path(spark, "song_per_session")
    keyed = music.song_per_session(inputs.events(spark, sf_dir))
    cluster_for_lookup(keyed, ["userId", "sessionId"], ["itemInSession"]).write.parquet(path)
    stored = read_parquet(spark, path)
    return lookup(stored, ["itemInSession"], userId=10, sessionId=1018).select(
        "itemInSession", "artist", "song"
    )


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT song, "userId", "firstName", "lastName" FROM log WHERE artist <> ''
QUALIFY 1 = row_number() OVER (PARTITION BY song, "userId" ORDER BY ts DESC, "firstName" DESC, "lastName" DESC)
""")
def upsert_listen_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history in a folder divided by key; only touched divisions are rewritten."""
    path = work_path(spark, "listen_buckets")
    played = music.play_rows(inputs.events(spark, sf_dir)).select(
        "song", "userId", "firstName", "lastName", "ts", "level"
    )
    upsert_buckets(played.where(F.col("level") == "free").drop("level"), path, ["song", "userId"], ["ts"])
    upsert_buckets(played.drop("level"), path, ["song", "userId"], ["ts"])
    return read_parquet(spark, path).drop("_bucket")


@QUERIES.add("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_mapping_file_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table filled from JSON files by the paths that a mapping file lists, in table order."""
    path, mapping = work_path(spark, "json_mapped"), work_path(spark, "json_mapping")
    rows = table(spark, sf_dir, "events")
    rows.select(
        F.col("event_id").alias("id"), F.from_json("props", "k int").alias("detail")
    ).write.json(path)
    listed = """{"jsonpaths": ["$.id", "$['detail']['k']"]}"""
    paths = rows.agg(F.first(F.lit(listed)).alias("value"))
    paths.write.text(mapping)
    name = _temporary_table(spark, "mapped_props", _PROPS)
    stage_table(spark, path, name, read_json_paths(spark, mapping, _PROPS))
    return read_table(spark, name)


@QUERIES.add("""
SELECT * FROM (VALUES
  ('account', 1, 'int'), ('name', 2, 'string'), ('balance', 3, 'decimal(18,2)')) AS t(col_name, position, data_type)
CROSS JOIN (SELECT count(*) AS customers FROM customer)
""")
def table_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data dictionary of a loaded table, with its number of rows."""
    name = _temporary_table(spark, "described_accounts", _ACCOUNTS)
    append_table(_accounts(spark, sf_dir), name)
    rows = read_table(spark, name).agg(F.count(F.lit(1)).alias("customers")).scalar()
    described = data_dictionary(spark, [name]).select("col_name", "position", "data_type")
    return described.withColumn("customers", rows)


@QUERIES.add("SELECT o_orderkey, o_orderstatus FROM orders")
def plain_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unpartitioned write that replaces an earlier one."""
    path = work_path(spark, "plain")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_parquet(orders.withColumn("o_orderstatus", F.lit("old")), path)
    write_parquet(orders, path)
    return read_parquet(spark, path)


# ---- identities, lookups and inserts by storage ------------------------------------

_NUMBERED = T.StructType([T.StructField("id", T.LongType()), T.StructField("o_orderkey", T.LongType())])


@QUERIES.add("""
WITH loads AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS load FROM orders)
SELECT o_orderkey, row_number() OVER (ORDER BY load, o_orderkey) AS id FROM loads
""")
def identity_over_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in three loads, and one without rows: ids go on from load to load without a gap."""
    name = _temporary_table(spark, "numbered_orders", _NUMBERED)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "none", "P"):
        append_with_identity(orders.where(F.col("o_orderstatus") == status), name, "id", ["o_orderkey"], start=1)
    return read_table(spark, name)


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL},
latest AS (
  SELECT "userId", "sessionId", "itemInSession", artist, song FROM log WHERE artist <> ''
  QUALIFY 1 = row_number() OVER (
    PARTITION BY "userId", "sessionId", "itemInSession"
    ORDER BY ts DESC, artist DESC, song DESC, "firstName" DESC, "lastName" DESC)
),
busiest AS (SELECT "userId" FROM latest GROUP BY ALL ORDER BY count(*) DESC, "userId" LIMIT 1)
SELECT row_number() OVER (ORDER BY "sessionId", "itemInSession") - 1 AS place, "sessionId",
       CAST("itemInSession" AS BIGINT) AS "itemInSession", artist, song
FROM latest JOIN busiest USING ("userId")
""")
def bucketed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All songs of the user who has most, in the order in which their one file keeps them."""
    name, path = f"{_DATABASE}.songs_by_user", work_path(spark, "songs_by_user")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_DATABASE}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keyed = music.song_per_session(inputs.events(spark, sf_dir))
    create_bucketed(keyed, name, ["userId"], ["sessionId", "itemInSession"], buckets=8, path=path)
    stored = read_table(spark, name)
    user = stored.groupBy("userId").count().orderBy(F.desc("count"), "userId").first()["userId"]
    return lookup(stored, userId=user).select(
        F.monotonically_increasing_id().alias("place"), "sessionId", "itemInSession", "artist", "song"
    )


@QUERIES.add("""
SELECT c_custkey AS account, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS DOUBLE) AS balance,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'first' ELSE 'second' END AS load
FROM customer
""")
def insert_new_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of one segment, then twice all of them, into a table in buckets by account."""
    name, path = f"{_DATABASE}.bucketed_accounts", work_path(spark, "bucketed_accounts")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_DATABASE}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    customer = table(spark, sf_dir, "customer")
    rows = customer.select(
        F.col("c_custkey").cast("int").alias("account"), F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), "c_mktsegment",
    )
    first = rows.where(F.col("c_mktsegment") == "AUTOMOBILE").drop("c_mktsegment")
    create_bucketed(first.withColumn("load", F.lit("first")), name, ["account"], buckets=8, path=path)
    for load in ("second", "third"):
        insert_new_bucketed(rows.withColumn("load", F.lit(load)), name, ["account"])
    return read_table(spark, name)


@QUERIES.add("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN length(c_name) > 12 THEN c_name[:9] || '...' ELSE c_name END AS c_name,
       c_mktsegment
FROM customer ORDER BY customer.c_custkey LIMIT 20
""")
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty customers, long values cut."""
    return preview(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").orderBy("c_custkey"), 20, 12)


@QUERIES.add(f"""
WITH {inputs.AREAS_SQL}
SELECT CASE WHEN n_nationkey IS NULL THEN NULL WHEN n_nationkey < 20 THEN 1000 + n_nationkey ELSE n_nationkey END AS location_id,
       n_name AS zone, count(*) AS events
FROM points
LEFT JOIN nation ON x > n_nationkey % 5 * 20 AND x < n_nationkey % 5 * 20 + 20
                AND y > n_nationkey // 5 * 20 AND y < n_nationkey // 5 * 20 + 20
GROUP BY ALL
""")
def geojson_two_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per zone from two overlapping GeoJSON files: where zones of both lie, that of the first file counts."""
    path = work_path(spark, "geojson_two")
    everything = inputs.zone_polygons(spark, sf_dir)
    renumbered = everything.where("location_id < 20").withColumn("location_id", F.col("location_id") + 1000)
    # the file that is written second comes first by its name
    for folder, zones in (("b", everything), ("a", renumbered)):
        zone_document(zones).write.text(f"{path}/{folder}")
    zones = read_zone_polygons(spark, [f"{path}/a", f"{path}/b"])
    return (
        locate_points(inputs.event_points(spark, sf_dir), zones, "x", "y", alias="z")
        .groupBy("z.location_id", "z.zone")
        .agg(F.count(F.lit(1)).alias("events"))
    )
