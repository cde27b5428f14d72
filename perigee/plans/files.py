"""Readers and writers on files that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.plans.population import _CAPPED_SQL, mart, rounded
from perigee.plans.registry import query, table
from perigee.session import scratch_path
from perigee.sources import tables, typed_csv
from perigee.spec import MART_COLUMNS, WITH_MOID

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_comment", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_shippriority", T.IntegerType()),
])


@query("csv_round_trip", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a "stray, quote ' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'plain' END AS o_comment,
      CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice, CAST(NULL AS INTEGER) AS o_shippriority,
      o_orderkey % 5 = 0 AS is_corrupt FROM orders""")
def csv_round_trip(spark, sf_dir):
    """Orders as CSV files with quotes in texts, unreadable prices and two orders of columns, read back by header name."""
    comment = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('a "stray, quote '), "o_orderkey")).when(F.col("o_orderkey") % 3 == 1, "plain")
    price = F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", comment.alias("o_comment"), price.alias("O_TotalPrice"))
    path = scratch_path(spark, "csv")
    tables.export_csv(orders.filter("o_orderkey % 2 = 0"), f"{path}/a")
    tables.export_csv(orders.filter("o_orderkey % 2 = 1").select("O_TotalPrice", "o_orderkey", "o_comment"), f"{path}/b")
    read = tables.read_csv_lenient(spark, [f"{path}/a", f"{path}/b"], ORDERS, mixed_headers=True)
    return read.select(*ORDERS.names, F.col(tables.CORRUPT).isNotNull().alias("is_corrupt"))


# Columns that only a scan of the whole file types right: a number late in an empty column, one fraction among whole numbers,
# one number beyond a long, one word among digits.
TYPED = {
    "event_id": "event_id", "sparse": "CASE WHEN event_id % 500 = 3 THEN value END",
    "mixed": "CASE WHEN event_id % 1000 = 0 THEN '0.5' ELSE CAST(event_id % 9 AS STRING) END",
    "big": "CASE WHEN event_id % 1000 = 1 THEN '9300000000000000000' ELSE CAST(event_id AS STRING) END",
    "day": "substr(CAST(ts AS STRING), 1, 10)", "moment": "substr(CAST(ts AS STRING), 1, 19)",
    "flag": "CAST(value < 100 AS STRING)", "code": "CASE WHEN event_id % 1000 = 7 THEN 'n/a' ELSE CAST(event_id % 9 AS STRING) END",
    "nothing": "CAST(NULL AS STRING)",
}


def typed_file(spark, sf_dir):
    path = scratch_path(spark, "typed")
    tables.export_csv(table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {c}" for c, e in TYPED.items()]), path)
    return path


@query("typed_csv", """
    SELECT event_id, CASE WHEN event_id % 500 = 3 THEN value END AS sparse,
      CASE WHEN event_id % 1000 = 0 THEN 0.5e0 ELSE CAST(event_id % 9 AS DOUBLE) END AS mixed,
      CASE WHEN event_id % 1000 = 1 THEN 9300000000000000000e0 ELSE CAST(event_id AS DOUBLE) END AS big,
      year(ts) * 10000 + month(ts) * 100 + day(ts) AS day_number,
      hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS second_of_day, value < 100 AS flag,
      CASE WHEN event_id % 1000 = 7 THEN 'n/a' ELSE CAST(event_id % 9 AS VARCHAR) END AS code, CAST(NULL AS VARCHAR) AS nothing FROM events""")
def typed_csv_rows(spark, sf_dir):
    """Events as a CSV file, read under the types that all values of a column have."""
    day, moment = F.col("day"), F.col("moment")
    return typed_csv.read_csv_typed(spark, typed_file(spark, sf_dir)).select(
        "event_id", "sparse", "mixed", "big", (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("long").alias("day_number"),
        (F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)).cast("long").alias("second_of_day"), "flag", "code", "nothing",
    )


@query("csv_types", """
    SELECT * FROM (VALUES ('event_id', 'bigint'), ('sparse', 'double'), ('mixed', CASE WHEN (SELECT max(event_id) FROM events) >= 0 THEN 'double' END), ('big', 'double'),
      ('day', 'date'), ('moment', 'timestamp'), ('flag', 'boolean'), ('code', 'string'), ('nothing', 'string')) AS t("column", type)""")
def csv_types(spark, sf_dir):
    raw = spark.read.option("header", True).csv(typed_file(spark, sf_dir))
    return typed_csv.type_table(spark, typed_csv.infer_types(raw))


_MART = ", ".join(f"round({c}, 6) AS {c}" for c in ("H", "e", "a", "q", "i", "per", "moid"))


@query("materialised_mart", f"WITH {_CAPPED_SQL} SELECT spkid, is_pha, is_neo, class, class_code, {_MART} FROM mart")
def materialised_mart(spark, sf_dir):
    stored = tables.write_table(mart(spark, sf_dir), scratch_path(spark, "mart"))
    return rounded(stored.select(*MART_COLUMNS))


@query("load_mart", f"""
    WITH {_CAPPED_SQL} SELECT spkid, CAST(is_pha AS INTEGER) AS is_pha, round(e, 6) AS e, round(q, 6) AS q, round(H, 6) AS H, is_neo, class_code,
      round(moid, 6) AS moid, class FROM mart""")
def load_mart(spark, sf_dir):
    path = scratch_path(spark, "mart")
    tables.write_table(mart(spark, sf_dir), path)
    return rounded(tables.load_mart(spark, path, WITH_MOID, ("class",)))


@query("seed_join", """
    WITH seed AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM events))
    SELECT CAST(code AS INTEGER) AS class_code, event_type AS class_abbr, count(*) AS n FROM events JOIN seed USING (event_type) GROUP BY ALL""")
def seed_join(spark, sf_dir):
    """A seed file written from the data, with a comment line and a quoted name, loaded and joined."""
    events = table(spark, sf_dir, "events")
    names = sorted(r[0] for r in events.select("event_type").distinct().collect())  # a closed list of types
    lines = ["# classes", "class_code,class_abbr,class_name", *[f'{i},{n},"{n}, ""quoted"""' for i, n in enumerate(names)]]
    path = scratch_path(spark, "seed")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    seed = tables.load_seed(spark, path, tables.CLASS_SEED_SCHEMA)
    joined = events.join(seed.filter(F.col("class_name").contains('"quoted"')), F.col("event_type") == F.col("class_abbr"))
    return joined.groupBy("class_code", "class_abbr").agg(F.count("*").alias("n"))
