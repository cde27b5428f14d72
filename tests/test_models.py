import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from perigee.operators import experiments as ex
from perigee.operators import models
from perigee.operators.sampling import three_way_split
from perigee.operators.scoring import apply_model, score
from perigee.spec import WITH_MOID, WITHOUT_MOID


@pytest.fixture(scope="module")
def split(spark):
    """Labels follow the two-condition rule; the other features carry little signal."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        moid, h = rng.uniform(0, 1.0), rng.uniform(10, 30)
        rows.append((i, moid <= 0.05 and h <= 22.0, rng.random() * 0.9, rng.uniform(0.1, 3), h, rng.random() < 0.5,
                     rng.randint(0, 12), moid))
    df = spark.createDataFrame(
        rows, "spkid bigint, is_pha boolean, e double, q double, H double, is_neo boolean, class_code int, moid double"
    )
    return three_way_split(df, "spkid", "is_pha").cache()


@pytest.fixture(scope="module")
def train(split):
    return ex.resampled_train(split, WITH_MOID).cache()


@pytest.fixture(scope="module")
def tree(split, train):
    return ex.run_experiment(split, WITH_MOID, "decision_tree", n_iter=2, train=train)


def test_tree_recovers_the_rule(spark, split, train):
    fitted = models.make_pipeline("decision_tree", WITH_MOID).fit(ex.sized(train, 1000))
    assert ex._metrics_of(fitted, split.filter("split = 'test'"), WITH_MOID)["pr_auc"] > 0.9
    top = {r["feature"] for r in models.feature_importances(fitted, WITH_MOID, spark).collect()[:2]}
    assert top == {"moid", "H"}
    rules = models.tree_rules(fitted, WITH_MOID)
    assert "moid" in rules and "feature 5" not in rules


def test_without_moid_is_worse(split, tree):
    blind = ex.run_experiment(split, WITHOUT_MOID, "decision_tree", n_iter=1)
    assert blind.test_metrics["pr_auc"] < tree.test_metrics["pr_auc"] - 0.3


def test_calibrated_svc_survives_a_round_trip(spark, split, train, tmp_path):
    result = ex.run_experiment(split, WITH_MOID, "linear_svc", train=train)
    assert 0.2 < result.test_metrics["pr_auc"] <= 1.0 and result.test_metrics["recall"] > 0.8
    result.model.write().overwrite().save(str(tmp_path / "svc"))
    loaded = PipelineModel.load(str(tmp_path / "svc"))
    test = ex._numeric(split.filter("split = 'test'"), WITH_MOID)
    probs = [apply_model(test, m, WITH_MOID).select("spkid", F.round("prob", 9)).orderBy("spkid").collect() for m in (result.model, loaded)]
    assert probs[0] == probs[1]
    assert all(0 <= r[1] <= 1 for r in probs[0])


def test_candidates_are_distinct_and_seeded():
    space = models.PARAM_SPACES["decision_tree"]
    a = ex.sample_candidates(space, 8, 42)
    assert a == ex.sample_candidates(space, 8, 42) and len({str(c) for c in a}) == 8
    assert len(ex.sample_candidates(space, 10_000, 1)) == 64
    with pytest.raises(ValueError):
        models.make_pipeline("svm", WITH_MOID)


def test_cross_validated_search(train):
    params, score_ = ex.cross_validated_search(train, WITH_MOID, "decision_tree", n_iter=1, folds=2)
    assert set(params) == {"max_depth", "min_samples_leaf", "criterion"} and 0.8 < score_ <= 1.0


def test_runs_results_and_champion(spark, tree, tmp_path):
    runs_path, dirs = str(tmp_path / "runs"), str(tmp_path / "models")
    params = {"feature_set": "exp2_moid_included", "dataset": "d"}
    ex.log_run(spark, runs_path, ex.ExperimentResult("decision_tree", {}, {}, {"pr_auc": 0.1}), params)
    last = ex.log_run(spark, runs_path, tree, params, dirs)
    runs = spark.read.schema(ex.RUN_SCHEMA).parquet(runs_path)
    assert runs.count() == 2
    latest = ex.latest_runs(runs).collect()
    assert [r["run_id"] for r in latest] == [last]
    assert "best_param__max_depth" in latest[0]["params"] and "val_pr_auc" in latest[0]["metrics"]
    row = ex.results_table(runs, "d").first()
    assert row["model"] == "Decision Tree" and row["pr_auc"] == round(tree.test_metrics["pr_auc"], 3)
    exported = ex.export_champion(runs, {"dataset": "d"}, str(tmp_path / "champion"))
    assert len(exported.stages) == 2
    with pytest.raises(LookupError):
        ex.export_champion(runs, {"dataset": "other"}, str(tmp_path / "none"))


def test_scoring_follows_the_rule_and_keeps_nulls(spark, tree):
    df = spark.createDataFrame([
        (1, 0.3, 0.9, 18.0, True, 1, 0.02, "x"), (2, 0.1, 2.5, 18.0, False, 8, 0.5, "y"), (3, None, 1.0, 18.0, True, 1, 0.02, "z"),
    ], "spkid bigint, e double, q double, H double, is_neo boolean, class_code int, moid double, extra string")
    rows = score(df, tree.model, WITH_MOID).orderBy("spkid").collect()
    assert rows[0]["is_pha"] and rows[0]["probability"] > 0.5 and "0.05 AU" in rows[0]["explanation"]
    assert not rows[1]["is_pha"] and rows[1]["probability"] < 0.5 and rows[1]["extra"] == "y"
    assert rows[2]["is_pha"] is None and rows[2]["probability"] is None and rows[2]["explanation"] is None
    with pytest.raises(ValueError):
        apply_model(df.drop("moid"), tree.model, WITH_MOID)


def test_weights_balance_classes(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    rows = {(r["y"], round(r["weight"], 6)) for r in models.balanced_weights(df, "y").collect()}
    assert rows == {(1, 2.0), (0, round(4 / 6, 6))}


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest"])
def test_other_models_rank_the_rule_well(split, train, name):
    params = {"n_estimators": 20} if name == "random_forest" else {}
    fitted = models.make_pipeline(name, WITH_MOID, 1000, **params).fit(ex.sized(train, 1000))
    found = ex._metrics_of(fitted, split.filter("split = 'test'"), WITH_MOID)
    assert found["roc_auc"] > 0.9 and found["recall"] > 0.8


def test_runs_log_the_depth_that_was_used(split, train, monkeypatch):
    monkeypatch.setitem(ex.PARAM_SPACES, "decision_tree", {"max_depth": [None]})
    result = ex.run_experiment(split, WITH_MOID, "decision_tree", n_iter=1, train=train)
    assert result.best_params == {"max_depth": models.UNLIMITED_DEPTH}
    assert result.model.stages[-1].getMaxDepth() == models.UNLIMITED_DEPTH


def test_squared_hinge_equals_a_dense_solution(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 4))
    y = np.where(x @ [1.0, -2.0, 0.5, 0.0] + 0.7 * rng.normal(size=2000) > 0.3, 1.0, -1.0)
    c = np.where(y > 0, 1.5, 0.5)
    rows = [(*map(float, r), float(s), float(k)) for r, s, k in zip(x, y, c)]
    data = spark.createDataFrame(rows, "a double, b double, c double, d double, sign double, cost double").cache()
    got = models.squared_hinge(data, ["a", "b", "c", "d"], "sign", "cost")
    z = np.hstack([x, np.ones((2000, 1))])
    w = np.zeros(5)
    for _ in range(20000):  # plain gradient descent with a safe step
        gap = np.maximum(0, 1 - y * (z @ w))
        w -= (w - 2 * (c * y * gap) @ z) / (1 + 2 * np.linalg.norm(z * np.sqrt(c)[:, None], 2) ** 2)
    assert np.abs(got - w).max() < 1e-4


def test_rules_of_a_forest_lead_to_its_leaves(spark, split, train):
    fitted = models.make_pipeline("random_forest", WITH_MOID, 1000, n_estimators=3, max_depth=3).fit(ex.sized(train, 1000))
    nodes = models.tree_nodes(fitted, WITH_MOID, spark).cache()
    rules = models.rule_table(nodes).collect()
    assert {r["tree"] for r in rules} == {0, 1, 2} and max(r["depth"] for r in rules) <= 3
    rows = ex._numeric(split.filter("split = 'test'"), WITH_MOID).limit(300).cache()
    met = {(r["spkid"], r["tree"]): r["node"] for r in models.walk_rules(rows, nodes, WITH_MOID.features, "spkid").collect()}
    assert len(met) == 3 * rows.count()
    for r in rules:  # every row that a rule's text holds for is at its leaf
        assert {met[x["spkid"], r["tree"]] for x in rows.filter(r["rule"]).select("spkid").collect()} <= {r["node"]}
