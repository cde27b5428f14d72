"""The ways that large data takes, run on the test tables: small limits given as parameters, results as everywhere else."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.operators import distributed, metrics, neighbours
from perigee.operators import resolve as rs
from perigee.plans import evaluation, lookup, neighbourhood  # noqa: F401 - their oracles hold here too
from perigee.plans.population import rounded
from perigee.plans.profiling import NUMERIC
from perigee.plans.registry import ORACLES, query, table

# Rows of a range of the global order.
RANGE_ROWS = 500
_SCORED = "(SELECT event_type = 'error' AS y, CASE WHEN event_id % 7 <> 0 THEN value END AS score FROM events)"
_NULL_POINTS = f"""
    per AS (SELECT score AS threshold, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM {_SCORED} GROUP BY score),
    run AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
            FROM per WINDOW w AS (ORDER BY threshold DESC NULLS LAST)),
    pts AS (SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp::DOUBLE / p AS recall,
                   tp::DOUBLE / (tp + fp) AS precision, pos::DOUBLE / p AS dr, neg::DOUBLE / n AS df, (tp - pos)::DOUBLE / p AS tpr0,
                   CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos)::DOUBLE / (tp - pos + fp - neg) ELSE 1 END AS prec0 FROM run)"""


def events_with_null_scores(spark, sf_dir):
    score = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return table(spark, sf_dir, "events").select((F.col("event_type") == "error").cast("int").alias("y"), score.alias("score"))


@query("pr_curve_nulls", f"""
    WITH {_NULL_POINTS} SELECT threshold, tp, fp, round(recall, 6) AS recall, round(precision, 6) AS precision FROM pts""")
def pr_curve_nulls(spark, sf_dir):
    points = metrics.curve_points(events_with_null_scores(spark, sf_dir), "y", "score", range_rows=RANGE_ROWS)
    return rounded(points.select("threshold", "tp", "fp", "recall", "precision")).withColumn("threshold", F.col("threshold"))


@query("pr_auc_nulls", f"""
    WITH {_NULL_POINTS} SELECT round(sum(dr * (precision + prec0) / 2), 6) AS pr_auc, round(sum(df * (recall + tpr0) / 2), 6) AS roc_auc FROM pts""")
def pr_auc_nulls(spark, sf_dir):
    points = metrics.curve_points(events_with_null_scores(spark, sf_dir), "y", "score", range_rows=RANGE_ROWS)
    return rounded(points.agg(F.sum("pr_area").alias("pr_auc"), F.sum("roc_area").alias("roc_auc")))


@query("pr_curve_ranges", ORACLES["pr_curve"])
def pr_curve_ranges(spark, sf_dir):
    points = metrics.curve_points(evaluation.scored_events(spark, sf_dir), "y", "score", range_rows=RANGE_ROWS)
    return points.select("threshold", "tp", "fp", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query("percentiles_bracketed", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.01), 6) AS p01, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.99), 6) AS p99 FROM lineitem"
    for c in NUMERIC))
def percentiles_bracketed(spark, sf_dir):
    found = distributed.exact_percentiles(table(spark, sf_dir, "lineitem"), NUMERIC, [0.01, 0.5, 0.99], small=1000, inside=100)
    return rounded(spark.createDataFrame([(c, *map(float, found[c])) for c in NUMERIC], "column string, p01 double, p50 double, p99 double"))


@query("hash_rank_buckets", """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR) || '_r'), event_id) AS rank FROM events""")
def hash_rank_buckets(spark, sf_dir):
    """Two digits of the hash: 256 buckets, as for tens of millions of rows."""
    ranked = distributed.hash_rank(table(spark, sf_dir, "events"), ["event_type"], "event_id", "_r", n_rows=30_000_000)
    return ranked.select("event_id", "event_type", "rank")


@query("knn_edges_pivots", ORACLES["knn_edges"])
def knn_edges_pivots(spark, sf_dir):
    return rounded(neighbours.knn_join(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10, cell_rows=40))


@query("fuzzy_candidates_common_words", ORACLES["fuzzy_candidates"])
def fuzzy_candidates_common_words(spark, sf_dir):
    """Words of three names or more count as common."""
    queries, names = lookup._open_queries(spark, sf_dir)
    return rounded(rs.fuzzy_candidates(queries, names, hot=2))
