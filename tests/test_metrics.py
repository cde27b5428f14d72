import pytest
from pyspark.sql import functions as F

from perigee.operators import metrics as m


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y int, s double")


def test_pr_auc_hand_example(spark):
    df = frame(spark, [(1, .9), (0, .9), (1, .8), (0, .7), (1, .6), (0, .2), (0, .1)])
    assert m.pr_auc(df, "y", "s").first()[0] == pytest.approx(0.627778, abs=1e-6)
    assert m.roc_auc(df, "y", "s").first()[0] == pytest.approx(8.5 / 12)


def test_perfect_and_one_class_scores(spark):
    perfect = frame(spark, [(1, .9), (0, .1)])
    assert m.pr_auc(perfect, "y", "s").first()[0] == 1.0
    best = m.best_f1_threshold(perfect, "y", "s").first()
    assert best["threshold"] == .9 and best["recall"] == 1.0
    negatives = frame(spark, [(0, .3), (0, .1)]).withColumn("p", F.lit(0))
    row = m.compute_metrics(negatives, "y", "p", "s").first()
    assert (row["recall"], row["precision"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert m.best_f1_threshold(negatives.limit(0), "y", "s").first()["threshold"] == 0.5


def test_best_threshold_prefers_the_smallest_of_equals(spark):
    # F1 is 2/3 at both .8 (p 1/1, r 1/2) and .2 (p 2/4, r 2/2).
    df = frame(spark, [(1, .8), (0, .5), (0, .4), (1, .2)])
    assert m.best_f1_threshold(df, "y", "s").first()["threshold"] == .2


def labels(spark, pairs):
    return m.contingency(spark.createDataFrame(pairs, "a int, b int"), "a", "b")


def test_agreement_scores(spark):
    permuted = labels(spark, [(i % 3, (i + 1) % 3) for i in range(30)])
    assert m.adjusted_rand(permuted).first()[0] == pytest.approx(1.0)
    assert m.normalized_mutual_info(permuted).first()[0] == pytest.approx(1.0)
    independent = labels(spark, [(i % 2, j) for i in range(10) for j in range(5)])
    assert m.normalized_mutual_info(independent).first()[0] == pytest.approx(0.0, abs=1e-12)
    trivial = labels(spark, [(0, 0)] * 5)
    assert m.adjusted_rand(trivial).first()[0] == 1.0
    assert m.normalized_mutual_info(trivial).first()[0] == 1.0


def test_quality_row_with_only_noise(spark):
    df = spark.createDataFrame([(i % 2, -1) for i in range(6)], "t int, l int")
    row = m.cluster_quality(df, "t", "l", "x").first()
    assert (row["n_clusters_found"], row["noise_fraction"], row["ari"]) == (0, 1.0, 0.0)
