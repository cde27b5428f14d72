"""Cleaning, caps, marts, names and data quality over the orders catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.operators import quality as dq
from perigee.operators import staging
from perigee.operators.profile import group_summary
from perigee.plans.registry import query, table
from perigee.sources.tables import align_to_schema, row_count_check

ELEMENTS = ("H", "e", "a", "q", "i", "per", "moid")

# Orders play the raw catalogue: blank and missing flags, an unknown class and missing elements are made here.
CATALOGUE = """
    o_orderkey AS spkid,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN ''
         WHEN o_totalprice > 400000 THEN 'Y' ELSE 'N' END AS pha,
    CASE WHEN o_orderkey % 60 = 2 THEN NULL WHEN o_orderkey % 60 = 3 THEN ''
         WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS neo,
    CASE WHEN o_orderkey % 70 = 4 THEN 'UNKNOWN' ELSE o_orderpriority END AS class,
    10 + CAST(o_custkey % 200 AS DOUBLE) / 10 AS H,
    CAST(o_custkey % 100 AS DOUBLE) / 100 AS e,
    o_totalprice / 98765 AS a,
    o_totalprice / 98765 * (1 - CAST(o_custkey % 100 AS DOUBLE) / 100) AS q,
    CAST(o_orderkey % 360 AS DOUBLE) / 2 AS i,
    CAST(o_orderkey % 1000 AS DOUBLE) / 3 AS per,
    CASE WHEN o_orderkey % 33 = 5 THEN NULL ELSE o_totalprice / 1999993 END AS moid
"""
_SEED_ROWS = [(0, "1-URGENT"), (1, "2-HIGH"), (2, "3-MEDIUM"), (3, "4-NOT SPECIFIED"), (4, "5-LOW")]

_RAW_SQL = f"raw AS (SELECT {CATALOGUE} FROM orders)"
_SEED_SQL = "seed(class_code, class_abbr) AS (VALUES " + ", ".join(f"({c}, '{a}')" for c, a in _SEED_ROWS) + ")"
_STAGED_SQL = f"""{_RAW_SQL}, {_SEED_SQL}, staged AS (
    SELECT spkid, pha = 'Y' AS is_pha, neo = 'Y' AS is_neo, class, H, e, a, q, i, per, moid, class_code
    FROM raw LEFT JOIN seed ON class = class_abbr
    WHERE pha IS NOT NULL AND pha <> '' AND neo IS NOT NULL AND neo <> '' AND moid IS NOT NULL
      AND class_code IS NOT NULL)"""
_CAPPED_SQL = f"""{_STAGED_SQL}, caps AS (
    SELECT quantile_cont(a, 0.99) AS a_p99, quantile_cont(q, 0.99) AS q_p99, quantile_cont(moid, 0.99) AS moid_p99,
           quantile_cont(i, 0.99) AS i_p99 FROM staged),
  mart AS (
    SELECT spkid, is_pha, is_neo, class, class_code, H, e, least(a, a_p99) AS a, least(q, q_p99) AS q,
           least(i, i_p99) AS i, per, least(moid, moid_p99) AS moid
    FROM staged CROSS JOIN caps)"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*split_columns(CATALOGUE))


def split_columns(fragment: str) -> list[str]:
    """Column expressions of a SELECT list, separated by commas at line ends."""
    lines, current = [], []
    for line in fragment.strip().splitlines():
        current.append(line.strip())
        if line.rstrip().endswith(","):
            lines.append(" ".join(current).rstrip(","))
            current = []
    return [*lines, " ".join(current)]


def class_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_SEED_ROWS, "class_code int, class_abbr string")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_bodies(catalogue(spark, sf_dir), class_seed(spark), ELEMENTS)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    population = staged(spark, sf_dir)
    caps = staging.feature_caps(population, ["a", "q", "moid", "i"])
    capped = staging.cap_upper(population, caps, ["a", "q", "moid", "i"])
    return capped.select("spkid", "is_pha", "is_neo", "class", "class_code", "H", "e", "a", "q", "i", "per", "moid")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, so that both engines agree to the last printed digit."""
    return df.withColumns({
        f.name: F.round(F.col(f.name), digits) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    })


_R = ", ".join(f"round({c}, 6) AS {c}" for c in ELEMENTS)


@query("stage_clean", f"WITH {_STAGED_SQL} SELECT spkid, is_pha, is_neo, class, class_code, {_R} FROM staged")
def stage_clean(spark, sf_dir):
    return rounded(staged(spark, sf_dir))


@query("capped_population", f"WITH {_CAPPED_SQL} SELECT spkid, is_pha, is_neo, class, class_code, {_R} FROM mart")
def capped_population(spark, sf_dir):
    return rounded(mart(spark, sf_dir))


@query("capped_class_summary", f"""
    WITH {_CAPPED_SQL} SELECT class_code, count(*) AS n, round(avg(moid), 6) AS avg_moid, round(avg(H), 6) AS avg_H,
      CAST(sum(CASE WHEN is_pha THEN 1 ELSE 0 END) AS BIGINT) AS n_pha FROM mart GROUP BY class_code""")
def capped_class_summary(spark, sf_dir):
    return rounded(group_summary(mart(spark, sf_dir), ["class_code"], ["moid", "H"], "is_pha", "n_pha"))


@query("feature_caps", """
    SELECT round(quantile_cont(l_extendedprice, 0.99), 6) AS l_extendedprice_p99,
           round(quantile_cont(l_quantity, 0.99), 6) AS l_quantity_p99,
           round(quantile_cont(l_discount, 0.99), 6) AS l_discount_p99 FROM lineitem""")
def feature_caps(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rounded(staging.feature_caps(lines, ["l_extendedprice", "l_quantity", "l_discount"]))


@query("capped_lines", """
    WITH caps AS (SELECT quantile_cont(l_extendedprice, 0.99) AS p, quantile_cont(l_quantity, 0.99) AS n FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round(least(l_extendedprice, p), 6) AS l_extendedprice,
           round(least(l_quantity, n), 6) AS l_quantity FROM lineitem CROSS JOIN caps""")
def capped_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    capped = staging.cap_upper(
        lines, staging.feature_caps(lines, ["l_extendedprice", "l_quantity"]), ["l_extendedprice", "l_quantity"]
    )
    return rounded(capped.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"))


@query("align_schema", """
    SELECT p_partkey AS PartKey, p_name AS P_NAME, CAST(p_size AS VARCHAR) AS P_SIZE,
           TRY_CAST(p_brand AS DOUBLE) AS P_BRAND, CAST(NULL AS DOUBLE) AS P_WEIGHT FROM part""")
def align_schema(spark, sf_dir):
    wanted = T.StructType([
        T.StructField("PartKey", T.LongType()), T.StructField("P_NAME", T.StringType()),
        T.StructField("P_SIZE", T.IntegerType()), T.StructField("P_BRAND", T.DoubleType()),
        T.StructField("P_WEIGHT", T.DoubleType()),
    ])
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "partkey")
    return align_to_schema(parts, wanted, {"p_size": "string"})


@query("row_count_contract", """
    SELECT 'lineitem' AS "check", CAST(60000 AS BIGINT) AS expected, count(*) AS actual, count(*) = 60000 AS ok
    FROM lineitem""")
def row_count_contract(spark, sf_dir):
    return row_count_check(table(spark, sf_dir, "lineitem"), 60_000, "lineitem")


@query("names_dim", f"""
    WITH {_CAPPED_SQL} SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM mart JOIN orders ON spkid = o_orderkey)""")
def names_dim(spark, sf_dir):
    """Customers that the mart's rows belong to."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("spkid"), F.col("o_custkey").alias("c_custkey"))
    fact = mart(spark, sf_dir).join(orders, "spkid")
    return staging.names_dim(table(spark, sf_dir, "customer"), fact, "c_custkey", ["c_name", "c_mktsegment"])


@query("full_records", f"""
    WITH {_CAPPED_SQL} SELECT spkid, c_name AS name, c_mktsegment AS segment, is_pha, round(H, 6) AS H,
      round(moid, 6) AS moid, o_orderstatus AS enriched
    FROM mart JOIN orders ON spkid = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def full_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("spkid"), F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("enriched")
    )
    people = table(spark, sf_dir, "customer")
    out = mart(spark, sf_dir).join(orders, "spkid").join(people, "c_custkey")
    return rounded(out.select(
        "spkid", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "is_pha", "H", "moid", "enriched"
    ))


@query("derived_codes", """
    SELECT o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def derived_codes(spark, sf_dir):
    return staging.derive_codes(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("engineered_features", f"""
    WITH {_STAGED_SQL} SELECT spkid,
      round(5.203e0 / a + 2 * sqrt((a / 5.203e0) * (1 - e * e)) * cos(radians(i)), 6) AS tisserand_J,
      round(-1.0e0 / a, 6) AS orbital_energy, round(moid / (e + 1e-9), 4) AS moid_ecc_ratio FROM staged""")
def engineered_features(spark, sf_dir):
    out = staging.orbital_features(staged(spark, sf_dir))
    return out.select(
        "spkid", F.round("tisserand_J", 6).alias("tisserand_J"), F.round("orbital_energy", 6).alias("orbital_energy"),
        F.round("moid_ecc_ratio", 4).alias("moid_ecc_ratio"),
    )


@query("quantile_clip", """
    WITH b AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
    SELECT event_id, round(least(greatest(value, lo), hi), 6) AS value FROM events CROSS JOIN b""")
def quantile_clip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(staging.clip_quantiles(events, ["value"]))


@query("dq_report", f"""
    WITH {_CAPPED_SQL}, report AS (
      SELECT 'not_null' AS "check", 'raw.spkid' AS target, count(*) FILTER (spkid IS NULL) AS failing,
             CAST(count(*) FILTER (spkid IS NULL) AS DOUBLE) AS observed FROM raw
      UNION ALL SELECT 'not_null', 'raw.pha', count(*) FILTER (pha IS NULL), count(*) FILTER (pha IS NULL) FROM raw
      UNION ALL SELECT 'not_null', 'raw.moid', count(*) FILTER (moid IS NULL), count(*) FILTER (moid IS NULL) FROM raw
      UNION ALL SELECT 'not_null', 'mart.moid', count(*) FILTER (moid IS NULL), count(*) FILTER (moid IS NULL) FROM mart
      UNION ALL SELECT 'accepted_values', 'mart.class_code', count(*) FILTER (class_code NOT IN (0, 1, 2, 3)),
             count(*) FILTER (class_code NOT IN (0, 1, 2, 3)) FROM mart
      UNION ALL SELECT 'ratio_band', 'mart.is_pha',
             CASE WHEN avg(CASE WHEN is_pha THEN 1.0e0 ELSE 0 END) BETWEEN 0.1 AND 0.3 THEN 0 ELSE 1 END,
             avg(CASE WHEN is_pha THEN 1.0e0 ELSE 0 END) FROM mart
      UNION ALL SELECT 'contiguous_codes', 'seed.class_code',
             CASE WHEN min(class_code) = 0 AND max(class_code) = 4 AND count(DISTINCT class_code) = 5 AND count(*) = 5
                  THEN 0 ELSE 1 END, count(DISTINCT class_code) FROM seed
      UNION ALL SELECT 'row_count', 'nation.*', abs(count(*) - 25), count(*) FROM nation
      UNION ALL SELECT 'unique', 'mart.spkid', count(*), count(*)
             FROM (SELECT spkid FROM mart GROUP BY spkid HAVING count(*) > 1)
      UNION ALL SELECT 'unique', 'part.p_name', count(*), count(*)
             FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)
      UNION ALL SELECT 'relationships', 'raw.class', count(*), count(*) FROM raw
             WHERE class NOT IN (SELECT class_abbr FROM seed)
      UNION ALL SELECT 'relationships', 'customer.c_nationkey', count(*), count(*) FROM customer
             WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
      UNION ALL SELECT 'reconcile', 'staged~mart.is_pha', 0, 0)
    SELECT "check", target, CAST(failing AS BIGINT) AS failing_rows, round(observed, 6) AS observed,
           failing = 0 AS passed FROM report""")
def dq_report(spark, sf_dir):
    tables = {
        "raw": catalogue(spark, sf_dir), "staged": staged(spark, sf_dir), "mart": mart(spark, sf_dir),
        "seed": class_seed(spark), **{t: table(spark, sf_dir, t) for t in ("nation", "customer", "part")},
    }
    checks = [
        dq.not_null("raw", "spkid"), dq.not_null("raw", "pha"), dq.not_null("raw", "moid"), dq.not_null("mart", "moid"),
        dq.accepted_values("mart", "class_code", [0, 1, 2, 3]), dq.ratio_band("mart", "is_pha", 0.1, 0.3),
        dq.contiguous_codes("seed", "class_code", 5), dq.row_count("nation", 25), dq.unique("mart", "spkid"),
        dq.unique("part", "p_name"), dq.relationships("raw", "class", "seed", "class_abbr"),
        dq.relationships("customer", "c_nationkey", "nation", "n_nationkey"), dq.reconcile("staged", "mart", "is_pha"),
    ]
    return rounded(dq.run_checks(spark, tables, checks))
