"""Metrics over events: the label is an error event, the score is its value."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.operators import metrics
from perigee.plans.population import rounded
from perigee.plans.registry import query, table


def scored_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        (F.col("event_type") == "error").cast("int").alias("y"), (F.col("value") >= 60).cast("int").alias("pred"),
        F.col("value").alias("score"),
    )


_POINTS = """
    per AS (SELECT value AS threshold, count(*) FILTER (event_type = 'error') AS pos,
                   count(*) FILTER (event_type <> 'error') AS neg FROM events GROUP BY value),
    run AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p,
                   sum(neg) OVER () AS n FROM per WINDOW w AS (ORDER BY threshold DESC)),
    pts AS (SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, fp::DOUBLE / n AS fpr,
                   tp::DOUBLE / p AS tpr, tp::DOUBLE / p AS recall, tp::DOUBLE / (tp + fp) AS precision,
                   pos::DOUBLE / p AS dr, neg::DOUBLE / n AS df,
                   CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos)::DOUBLE / (tp - pos + fp - neg) ELSE 1 END AS prec0,
                   (tp - pos)::DOUBLE / p AS tpr0 FROM run)"""
_PR = "sum(dr * (precision + prec0) / 2)"
_ROC = "sum(df * (tpr + tpr0) / 2)"
_COUNTS = """c AS (SELECT count(*) FILTER (event_type = 'error' AND value >= 60) AS tp,
      count(*) FILTER (event_type = 'error' AND value < 60) AS fn,
      count(*) FILTER (event_type <> 'error' AND value >= 60) AS fp,
      count(*) FILTER (event_type <> 'error' AND value < 60) AS tn FROM events)"""
_CONFUSION = """round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
      round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1, round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 6) AS accuracy,
      round((tn + fp) / (tp + tn + fp + fn)::DOUBLE, 6) AS naive_baseline_accuracy,
      tp AS true_positives, fn AS false_negatives, fp AS false_positives, tn AS true_negatives"""


@query("confusion_metrics", f"WITH {_COUNTS} SELECT {_CONFUSION} FROM c")
def confusion_metrics(spark, sf_dir):
    return rounded(metrics.confusion(scored_events(spark, sf_dir), "y", "pred"))


@query("full_metrics", f"""
    WITH {_COUNTS}, {_POINTS}, areas AS (SELECT {_PR} AS pr, {_ROC} AS roc FROM pts)
    SELECT {_CONFUSION}, round(pr, 6) AS pr_auc, round(roc, 6) AS roc_auc FROM c CROSS JOIN areas""")
def full_metrics(spark, sf_dir):
    return rounded(metrics.compute_metrics(scored_events(spark, sf_dir), "y", "pred", "score"))


@query("pr_curve", f"""
    WITH {_POINTS} SELECT threshold, tp, fp, round(recall, 6) AS recall, round(precision, 6) AS precision FROM pts""")
def pr_curve(spark, sf_dir):
    points = metrics.curve_points(scored_events(spark, sf_dir), "y", "score")
    return points.select(
        "threshold", "tp", "fp", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision")
    )


@query("roc_curve", f"WITH {_POINTS} SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM pts")
def roc_curve(spark, sf_dir):
    points = metrics.curve_points(scored_events(spark, sf_dir), "y", "score")
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("pr_auc", f"WITH {_POINTS} SELECT round({_PR}, 6) AS pr_auc FROM pts")
def pr_auc(spark, sf_dir):
    return rounded(metrics.pr_auc(scored_events(spark, sf_dir), "y", "score"))


@query("roc_auc", f"WITH {_POINTS} SELECT round({_ROC}, 6) AS roc_auc FROM pts")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored_events(spark, sf_dir), "y", "score"))


@query("best_threshold", f"""
    WITH {_POINTS}, f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM pts)
    SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
    FROM f ORDER BY f.f1 DESC, threshold LIMIT 1""")
def best_threshold(spark, sf_dir):
    return rounded(metrics.best_f1_threshold(scored_events(spark, sf_dir), "y", "score"))


@query("tuned_predictions", """
    SELECT event_id, CAST(value >= 60 AS INTEGER) AS pred FROM events""")
def tuned_predictions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return metrics.apply_threshold(events, "value", 60.0).select("event_id", "pred")


_CT = """ct AS (SELECT event_type AS a, CAST(floor(value / 25) AS INTEGER) AS b, count(*) AS n FROM events GROUP BY 1, 2),
    ra AS (SELECT a, sum(n)::DOUBLE AS n FROM ct GROUP BY a), rb AS (SELECT b, sum(n)::DOUBLE AS n FROM ct GROUP BY b),
    t AS (SELECT sum(n)::DOUBLE AS n FROM ct)"""


def _contingency(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("band", F.floor(F.col("value") / 25).cast("int"))
    return metrics.contingency(events, "event_type", "band")


@query("contingency", f"WITH {_CT} SELECT a, b, n FROM ct")
def contingency(spark, sf_dir):
    return _contingency(spark, sf_dir)


@query("ari", f"""
    WITH {_CT}, s AS (SELECT (SELECT sum(n::DOUBLE * (n - 1) / 2) FROM ct) AS x, (SELECT sum(n * (n - 1) / 2) FROM ra) AS r,
      (SELECT sum(n * (n - 1) / 2) FROM rb) AS c, (SELECT n * (n - 1) / 2 FROM t) AS tot)
    SELECT round((x - r * c / tot) / ((r + c) / 2 - r * c / tot), 6) AS ari FROM s""")
def ari(spark, sf_dir):
    return rounded(metrics.adjusted_rand(_contingency(spark, sf_dir)))


@query("nmi", f"""
    WITH {_CT}, mi AS (SELECT sum(ct.n / t.n * ln(ct.n * t.n / (ra.n * rb.n))) AS v FROM ct JOIN ra ON ct.a = ra.a
      JOIN rb ON ct.b = rb.b CROSS JOIN t),
    ha AS (SELECT -sum(ra.n / t.n * ln(ra.n / t.n)) AS v FROM ra CROSS JOIN t),
    hb AS (SELECT -sum(rb.n / t.n * ln(rb.n / t.n)) AS v FROM rb CROSS JOIN t)
    SELECT round(greatest(0, mi.v / ((ha.v + hb.v) / 2)), 6) AS nmi FROM mi CROSS JOIN ha CROSS JOIN hb""")
def nmi(spark, sf_dir):
    return rounded(metrics.normalized_mutual_info(_contingency(spark, sf_dir)))


@query("cluster_summary", """
    WITH l AS (SELECT CASE WHEN value < 5 THEN -1 ELSE CAST(floor(value / 25) AS INTEGER) END AS b FROM events)
    SELECT CAST(count(DISTINCT b) FILTER (b <> -1) AS INTEGER) AS n_clusters_found,
      round(avg(CASE WHEN b = -1 THEN 1.0e0 ELSE 0 END), 6) AS noise_fraction FROM l""")
def cluster_summary(spark, sf_dir):
    labels = table(spark, sf_dir, "events").selectExpr(
        "event_type", "CASE WHEN value < 5 THEN -1 ELSE CAST(floor(value / 25) AS INT) END AS band"
    )
    out = metrics.cluster_quality(labels, "event_type", "band", "bands")
    return rounded(out.select("n_clusters_found", "noise_fraction"))
