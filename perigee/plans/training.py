"""Run table queries over events, and model training on bodies labelled by the two-condition rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.functions.text import rule_met
from perigee.operators import experiments as ex
from perigee.operators import models, scoring
from perigee.operators.metrics import METRIC_FIELDS
from perigee.operators.sampling import three_way_split
from perigee.plans.lookup import BODY_SQL, bodies
from perigee.plans.population import rounded
from perigee.plans.registry import query, table
from perigee.session import cut_lineage, scratch_path
from perigee.spec import FEATURE_SETS, WITH_MOID, WITHOUT_MOID

_MODEL = "CASE user_id % 5 WHEN 0 THEN 'logistic_regression' WHEN 1 THEN 'decision_tree' WHEN 2 THEN 'random_forest' WHEN 3 THEN 'linear_svc' ELSE 'other_model' END"
_SET = "CASE WHEN event_type IN ('click', 'view') THEN 'exp1_moid_excluded' ELSE 'exp2_moid_included' END"
_DATASET = "CASE WHEN user_id % 2 = 0 THEN 'full_population' ELSE 'sample_100k' END"


def event_runs(spark, sf_dir):
    """Every event as one logged run."""
    score = F.col("value") / 501
    return table(spark, sf_dir, "events").select(
        F.format_string("r%09d", "event_id").alias("run_id"), F.col("ts").alias("start_time"),
        F.create_map(
            F.lit("model_name"), F.expr(_MODEL), F.lit("feature_set"), F.expr(_SET), F.lit("dataset"), F.expr(_DATASET),
        ).alias("params"),
        F.create_map(*[p for i, m in enumerate(ex.REPORTED) for p in (F.lit(f"test_{m}"), score / (i + 1))]).alias("metrics"),
        F.lit(None).cast("string").alias("model_path"),
    )


_RUNS = f"""runs AS (SELECT 'r' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS run_id, ts, {_MODEL} AS model_name,
      {_SET} AS feature_set, {_DATASET} AS dataset, value / 501 AS score FROM events)"""
_LATEST = "QUALIFY row_number() OVER (PARTITION BY feature_set, model_name ORDER BY ts DESC, run_id DESC) = 1"


@query("latest_runs", f"""
    WITH {_RUNS} SELECT run_id, feature_set, model_name, dataset, round(score / 4, 6) AS test_pr_auc FROM runs {_LATEST}""")
def latest_runs(spark, sf_dir):
    p, m = F.col("params"), F.col("metrics")
    return rounded(ex.latest_runs(event_runs(spark, sf_dir)).select(
        "run_id", p["feature_set"].alias("feature_set"), p["model_name"].alias("model_name"), p["dataset"].alias("dataset"),
        m["test_pr_auc"].alias("test_pr_auc"),
    ))


@query("results_table", f"""
    WITH {_RUNS}, latest AS (SELECT * FROM runs WHERE dataset = 'full_population' {_LATEST})
    SELECT feature_set, CASE model_name WHEN 'logistic_regression' THEN 'Logistic Regression' WHEN 'decision_tree' THEN 'Decision Tree'
      WHEN 'random_forest' THEN 'Random Forest' WHEN 'linear_svc' THEN 'Linear SVC' ELSE model_name END AS model,
      round(score, 3) AS recall, round(score / 2, 3) AS precision, round(score / 3, 3) AS f1, round(score / 4, 3) AS pr_auc,
      round(score / 5, 3) AS roc_auc FROM latest""")
def results_table(spark, sf_dir):
    return ex.results_table(event_runs(spark, sf_dir), "full_population")


@query("champion", f"""
    WITH {_RUNS} SELECT run_id, round(score / 4, 6) AS test_pr_auc FROM runs WHERE dataset = 'full_population'
      AND feature_set = 'exp2_moid_included' AND model_name = 'decision_tree' ORDER BY ts DESC, run_id DESC LIMIT 1""")
def champion(spark, sf_dir):
    row = ex.champion(event_runs(spark, sf_dir), {
        "dataset": "full_population", "feature_set": "exp2_moid_included", "model_name": "decision_tree",
    })
    return rounded(row.select("run_id", F.col("metrics")["test_pr_auc"].alias("test_pr_auc")))


def labelled_bodies(spark, sf_dir):
    return bodies(spark, sf_dir).withColumn("is_pha", rule_met(F.col("moid"), F.col("H")))


def _split(spark, sf_dir):
    return cut_lineage(three_way_split(labelled_bodies(spark, sf_dir), "spkid", "is_pha"))


def _experiment(spark, sf_dir, model, spec=WITH_MOID, n_iter=10):
    result = ex.run_experiment(_split(spark, sf_dir), spec, model, n_iter=n_iter)
    row = [(model, *[float(result.test_metrics[m]) for m in METRIC_FIELDS])]
    return spark.createDataFrame(row, "model string, " + ", ".join(f"{m} double" for m in METRIC_FIELDS))


@query("train_logistic_regression")
def train_logistic_regression(spark, sf_dir):
    return _experiment(spark, sf_dir, "logistic_regression")


@query("train_decision_tree")
def train_decision_tree(spark, sf_dir):
    return _experiment(spark, sf_dir, "decision_tree")


@query("train_decision_tree_without_moid")
def train_decision_tree_without_moid(spark, sf_dir):
    return _experiment(spark, sf_dir, "decision_tree", WITHOUT_MOID)


@query("train_random_forest")
def train_random_forest(spark, sf_dir):
    return _experiment(spark, sf_dir, "random_forest")


@query("train_linear_svc")
def train_linear_svc(spark, sf_dir):
    return _experiment(spark, sf_dir, "linear_svc")


def fitted_tree(spark, sf_dir):
    train = ex.resampled_train(_split(spark, sf_dir), WITH_MOID)
    n_rows = train.count()
    return models.make_pipeline("decision_tree", WITH_MOID, n_rows).fit(ex.sized(train, n_rows))


@query("feature_importances")
def feature_importances(spark, sf_dir):
    return models.feature_importances(fitted_tree(spark, sf_dir), WITH_MOID, spark)


@query("tree_rule_predictions", f"""
    WITH {BODY_SQL} SELECT count(*) AS n_rows, count(*) AS n_one_rule, count(*) AS n_as_predicted, count(*) AS n_in_stated_bounds FROM bodies""")
def tree_rule_predictions(spark, sf_dir):
    """All bodies through the rules of a fitted tree: each meets one rule, whose class is the model's, and the bounds that its text states."""
    model = fitted_tree(spark, sf_dir)
    nodes = cut_lineage(models.tree_nodes(model, WITH_MOID, spark))
    rules = cut_lineage(models.rule_table(nodes))
    rows = cut_lineage(ex._numeric(labelled_bodies(spark, sf_dir), WITH_MOID))
    met = models.walk_rules(rows, nodes, WITH_MOID.features, "spkid").join(F.broadcast(rules), ["tree", "node"])
    predicted = scoring.apply_model(rows, model, WITH_MOID).select("spkid", "pred")
    # The texts themselves, applied as conditions: a fitted tree of depth four has at most sixteen.
    by_text = F.coalesce(*[F.when(F.expr(r["rule"]), F.lit(r["node"])) for r in rules.select("rule", "node").collect()], F.lit(-1))
    stated = rows.select("spkid", by_text.alias("stated"))
    one = met.groupBy("spkid").agg(F.count("*").alias("n"), F.first("prediction").alias("prediction"), F.first("node").alias("node"))
    return rows.select("spkid").join(one, "spkid", "left").join(predicted, "spkid").join(stated, "spkid").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("n") == 1).alias("n_one_rule"), F.count_if(F.col("prediction") == F.col("pred")).alias("n_as_predicted"),
        F.count_if(F.col("stated") == F.col("node")).alias("n_in_stated_bounds"),
    )


@query("class_weights", """
    WITH b AS (SELECT event_type = 'error' AS y FROM events), n AS (SELECT count(*) AS t, count(*) FILTER (y) AS p FROM b)
    SELECT CAST(y AS INTEGER) AS y, round(CASE WHEN y THEN t / (2.0e0 * p) ELSE t / (2.0e0 * (t - p)) END, 6) AS weight, count(*) AS n
    FROM b CROSS JOIN n GROUP BY ALL""")
def class_weights(spark, sf_dir):
    labelled = table(spark, sf_dir, "events").select((F.col("event_type") == "error").cast("int").alias("y"))
    return rounded(models.balanced_weights(labelled, "y").groupBy("y", "weight").agg(F.count("*").alias("n")))


@query("experiment_grid")
def experiment_grid(spark, sf_dir):
    """Both feature sets with all four models, logged, exported as champion and reported; three draws a search, as in the published run."""
    base = scratch_path(spark, "grid")
    runs = ex.run_grid(
        spark, labelled_bodies(spark, sf_dir), FEATURE_SETS, f"{base}/runs", "bodies", n_iter=3, model_dir=f"{base}/models",
    )
    ex.export_champion(runs, {
        "dataset": "bodies", "feature_set": "exp2_moid_included", "model_name": "decision_tree",
    }, f"{base}/champion")
    return ex.results_table(runs, "bodies")


_LEAST_PR_AUC = {"logistic_regression": 0.3, "decision_tree": 0.9, "random_forest": 0.9, "linear_svc": 0.3}


@query("training_checks", f"""
    WITH {BODY_SQL}, n AS (SELECT count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM (SELECT moid <= 0.05 AND H <= 22 AS y FROM bodies)),
    t AS (SELECT CAST(round(p * 0.2e0) AS BIGINT) AS p, CAST(round(n * 0.2e0) AS BIGINT) AS n FROM n)
    SELECT model, p AS test_positives, n AS test_negatives, round(n / (p + n)::DOUBLE, 6) AS naive_baseline_accuracy, true AS counts_add_up, true AS pr_auc_reached
    FROM t CROSS JOIN (VALUES {', '.join(f"('{m}')" for m in _LEAST_PR_AUC)}) AS v(model)""")
def training_checks(spark, sf_dir):
    """What is certain of the trained models: sizes of the test split, counts that add up, and a least quality."""
    split = _split(spark, sf_dir)
    train = ex.resampled_train(split, WITH_MOID)
    rows = []
    for model, least in _LEAST_PR_AUC.items():
        m = ex.run_experiment(split, WITH_MOID, model, n_iter=1, train=train).test_metrics
        tp, fn, fp, tn = (int(m[c]) for c in ("true_positives", "false_negatives", "false_positives", "true_negatives"))
        adds_up = abs(m["accuracy"] * (tp + fn + fp + tn) - tp - tn) < 1e-6 and 0 <= m["recall"] <= 1 and 0 <= m["precision"] <= 1
        rows.append((model, tp + fn, fp + tn, float(m["naive_baseline_accuracy"]), adds_up, m["pr_auc"] >= least))
    return rounded(spark.createDataFrame(
        rows, "model string, test_positives bigint, test_negatives bigint, naive_baseline_accuracy double, counts_add_up boolean, pr_auc_reached boolean"
    ))
