"""Classification metrics and clustering agreement, from aggregates and range-partitioned running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.distributed import BUCKET_ROWS, running_totals
from perigee.session import cut_lineage

# Metric names.
METRIC_FIELDS = (
    "recall", "precision", "f1", "pr_auc", "roc_auc", "accuracy", "naive_baseline_accuracy", "true_positives",
    "false_negatives", "false_positives", "true_negatives",
)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: the four counts, recall, precision, F1, accuracy and the all-negative baseline."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")

    def count(actual: int, predicted: int) -> Column:
        return F.count(F.when((y == actual) & (p == predicted), 1))

    row = df.agg(
        count(1, 1).alias("true_positives"), count(1, 0).alias("false_negatives"),
        count(0, 1).alias("false_positives"), count(0, 0).alias("true_negatives"),
    )
    tp, fn, fp, tn = (F.col(c) for c in ("true_positives", "false_negatives", "false_positives", "true_negatives"))
    return row.select(
        _ratio(tp, tp + fn).alias("recall"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tn + fp, tp + tn + fp + fn).alias("naive_baseline_accuracy"),
        "true_positives", "false_negatives", "false_positives", "true_negatives",
    )


def curve_points(df: DataFrame, label: str, score: str, range_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per distinct score, as a threshold: running tp and fp, (fpr, tpr) and (recall, precision).

    Rows are reduced to one per score before anything is ordered. The precision-recall curve is anchored at recall 0,
    precision 1. ``pr_area`` and ``roc_area`` are the trapezoids between a point and the one before it; the point
    before is the running sum minus the row's own counts, so no lag over the global order is needed. Rows without a
    score come last, as one threshold that is null: they are the last to be called positive.
    """
    y = F.col(label).cast("int")
    # Stored once: the ranges, their totals and the running sums each read it.
    per_score = cut_lineage(df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count(F.when(y == 1, 1)).alias("pos"), F.count(F.when(y == 0, 1)).alias("neg")
    ))
    run = running_totals(per_score, "threshold", ["pos", "neg"], range_rows=range_rows)
    tp, fp, p, n = F.col("cum_pos"), F.col("cum_neg"), F.col("total_pos"), F.col("total_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    precision = _ratio(tp, tp + fp)
    precision0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    return run.select(
        "threshold", tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
        _ratio(fp, n).alias("fpr"), _ratio(tp, p).alias("tpr"),
        _ratio(tp, p).alias("recall"), precision.alias("precision"), _ratio(F.col("pos"), p).alias("recall_gain"),
        (_ratio(F.col("pos"), p) * (precision + precision0) / 2).alias("pr_area"),
        (_ratio(F.col("neg"), n) * (_ratio(tp, p) + _ratio(tp0, p)) / 2).alias("roc_area"),
    )


def pr_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_points(df, label, score).agg(F.sum("pr_area").alias("pr_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_points(df, label, score).agg(F.sum("roc_area").alias("roc_auc"))


def compute_metrics(df: DataFrame, label: str, pred: str, score: str) -> DataFrame:
    """One row with all eleven metrics."""
    areas = curve_points(df, label, score).agg(F.sum("pr_area").alias("pr_auc"), F.sum("roc_area").alias("roc_auc"))
    area = areas.select(F.struct("pr_auc", "roc_auc")).scalar()
    row = confusion(df, label, pred)
    return row.withColumns({"pr_auc": area.getField("pr_auc"), "roc_auc": area.getField("roc_auc")}).select(*METRIC_FIELDS)


def best_f1_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold with the highest F1; among equals the smallest. 0.5 for an empty frame."""
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-9))
    points = curve_points(df, label, score).withColumn("f1", f1)
    best = points.agg(F.max_by(
        F.struct("threshold", "precision", "recall", "f1"), F.struct(F.col("f1"), -F.col("threshold"))
    ).alias("b"))
    return best.select(
        F.coalesce(F.col("b.threshold"), F.lit(0.5)).alias("threshold"),
        F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall"), F.col("b.f1").alias("f1"),
    )


def apply_threshold(df: DataFrame, score: str, threshold: float, out: str = "pred") -> DataFrame:
    return df.withColumn(out, (F.col(score) >= F.lit(threshold)).cast("int"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per (class, cluster): columns ``a``, ``b``, ``n``."""
    return df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))


def _margins(ct: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        ct.groupBy("a").agg(F.sum("n").alias("n")),
        ct.groupBy("b").agg(F.sum("n").alias("n")),
    )


def adjusted_rand(ct: DataFrame) -> DataFrame:
    """Adjusted Rand index from a contingency table; two trivial partitions agree fully."""
    def pairs(frame: DataFrame) -> Column:
        x = F.col("n").cast("double")
        return frame.agg(F.struct(F.sum(x * (x - 1) / 2).alias("pairs"), F.sum(x).alias("n"))).scalar()

    rows, cols = _margins(ct)
    one = ct.sparkSession.range(1)
    base = one.select(pairs(ct).alias("cells"), pairs(rows).alias("rows"), pairs(cols).alias("cols"))
    index, left, right, n = F.col("cells.pairs"), F.col("rows.pairs"), F.col("cols.pairs"), F.col("cells.n")
    expected = F.when(n > 1, left * right / (n * (n - 1) / 2)).otherwise(F.lit(0.0))
    top = (left + right) / 2
    return base.select(F.when(top == expected, F.lit(1.0)).otherwise((index - expected) / (top - expected)).alias("ari"))


def normalized_mutual_info(ct: DataFrame) -> DataFrame:
    """Mutual information over the arithmetic mean of both entropies."""
    rows, cols = _margins(ct)
    total = ct.agg(F.sum("n").cast("double")).scalar()

    def entropy(frame: DataFrame) -> Column:
        p = F.col("n") / total
        return frame.agg(F.sum(-p * F.log(p))).scalar()

    joined = ct.join(rows.withColumnRenamed("n", "na"), "a").join(cols.withColumnRenamed("n", "nb"), "b")
    p = F.col("n") / total
    mutual = joined.agg(F.sum(p * F.log(F.col("n") * total / (F.col("na").cast("double") * F.col("nb"))))).scalar()
    base = ct.sparkSession.range(1).select(mutual.alias("mi"), entropy(rows).alias("ha"), entropy(cols).alias("hb"))
    mean = (F.col("ha") + F.col("hb")) / 2
    # Two single-cluster partitions have no entropy and agree fully; one trivial side alone shares nothing.
    return base.select(F.when(mean == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.col("mi") / mean)).alias("nmi"))


def cluster_quality(df: DataFrame, truth: str, label: str, method: str, noise: int = -1) -> DataFrame:
    """One result row: method, clusters found without noise, ARI, NMI and noise share. Noise is a cluster in ARI/NMI."""
    ct = cut_lineage(contingency(df, truth, label))
    ari, nmi = adjusted_rand(ct).first()[0], normalized_mutual_info(ct).first()[0]  # two numbers
    return ct.agg(
        F.count_distinct(F.when(F.col("b") != noise, F.col("b"))).cast("int").alias("n_clusters_found"),
        (F.sum(F.when(F.col("b") == noise, F.col("n")).otherwise(0)) / F.sum("n")).alias("noise_fraction"),
    ).select(
        F.lit(method).alias("method"), "n_clusters_found", F.lit(ari).alias("ari"), F.lit(nmi).alias("nmi"), "noise_fraction"
    )
