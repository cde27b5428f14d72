"""Profiles, histograms and correlations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.operators import profile
from perigee.plans.population import rounded
from perigee.plans.registry import query, table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("group_summary", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS avg_l_quantity,
      round(avg(l_extendedprice), 4) AS avg_l_extendedprice,
      CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_discounted
    FROM lineitem GROUP BY ALL""")
def group_summary(spark, sf_dir):
    out = profile.group_summary(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"],
        F.col("l_discount") > 0.05, "n_discounted",
    )
    return out.withColumns({
        "avg_l_quantity": F.round("avg_l_quantity", 6), "avg_l_extendedprice": F.round("avg_l_extendedprice", 4),
    })


@query("class_counts", """
    SELECT lang, n, round(n * 100.0e0 / sum(n) OVER (), 6) AS pct, round(max(n) OVER () / n::DOUBLE, 6) AS ratio
    FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""")
def class_counts(spark, sf_dir):
    return rounded(profile.class_counts(table(spark, sf_dir, "documents"), "lang"))


@query("missing_profile", """
    WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang, nullif(source, 'web') AS source,
                      CASE WHEN n_chars >= 1000 THEN n_chars END AS n_chars FROM documents),
    m AS (SELECT 'lang' AS "column", count(*) FILTER (lang IS NULL) AS missing_count, count(*) AS n FROM d
      UNION ALL SELECT 'source', count(*) FILTER (source IS NULL), count(*) FROM d
      UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars IS NULL), count(*) FROM d
      UNION ALL SELECT 'doc_id', count(*) FILTER (doc_id IS NULL), count(*) FROM d)
    SELECT "column", missing_count, round(missing_count * 100.0e0 / n, 2) AS missing_pct FROM m WHERE missing_count > 0""")
def missing_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "nullif(lang, 'en') AS lang", "nullif(source, 'web') AS source",
        "CASE WHEN n_chars >= 1000 THEN n_chars END AS n_chars",
    )
    return profile.missing_profile(docs)


def _per_column(select: str, columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns)


@query("describe_exact", _per_column(
    "count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,"
    " round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,"
    " round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max", NUMERIC, "lineitem"))
def describe_exact(spark, sf_dir):
    out = profile.describe_exact(table(spark, sf_dir, "lineitem"), NUMERIC)
    return out.withColumns({
        "mean": F.round("mean", 4), "std": F.round("std", 4),
        **{c: F.round(c, 6) for c in ("p25", "p50", "p75")},
    })


@query("extreme_profile", _per_column(
    "CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.5), 6) AS median,"
    " round(quantile_cont({c}, 0.95), 6) AS p95, round(quantile_cont({c}, 0.99), 6) AS p99,"
    " CAST(max({c}) AS DOUBLE) AS max", NUMERIC, "lineitem"))
def extreme_profile(spark, sf_dir):
    return rounded(profile.extreme_profile(table(spark, sf_dir, "lineitem"), NUMERIC))


_BIN = "CAST(least(floor((value - lo) / ((hi - lo) / {n})), {n} - 1) AS INTEGER)"


@query("histogram", f"""
    WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT {_BIN.format(n=80)} AS bin, any_value(lo) AS lo, any_value((hi - lo) / 80) AS w, count(*) AS n
          FROM events CROSS JOIN r GROUP BY 1)
    SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, n FROM b""")
def histogram(spark, sf_dir):
    return rounded(profile.histogram(table(spark, sf_dir, "events"), "value", 80))


@query("histogram_by_class", f"""
    WITH r AS (SELECT event_type AS t, min(value) AS lo, max(value) AS hi, count(*) AS total FROM events GROUP BY 1),
    b AS (SELECT event_type, {_BIN.format(n=60)} AS bin, any_value(lo) AS lo, any_value((hi - lo) / 60) AS w,
                 any_value(total) AS total, count(*) AS n
          FROM events JOIN r ON event_type = t GROUP BY 1, 2)
    SELECT event_type, bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, n,
           round(n / (total * w), 6) AS density FROM b""")
def histogram_by_class(spark, sf_dir):
    return rounded(profile.histogram(table(spark, sf_dir, "events"), "value", 60, by="event_type", density=True))


_TARGET = "CASE WHEN l_returnflag = 'R' THEN 1.0e0 ELSE 0.0e0 END"


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in NUMERIC for b in NUMERIC))
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(table(spark, sf_dir, "lineitem"), NUMERIC))


@query("target_correlation", _per_column(f"round(corr({{c}}, {_TARGET}), 6) AS corr", NUMERIC, "lineitem"))
def target_correlation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    return rounded(profile.target_correlation(lines, "returned", NUMERIC))
