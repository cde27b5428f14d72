"""Experiments: resample, search on validation, refit, touch test once; run table, results and champion."""

from __future__ import annotations

import random
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.metrics import METRIC_FIELDS, compute_metrics, curve_points
from perigee.operators.models import ALL_MODELS, PARAM_SPACES, SEED, make_pipeline, used_params
from perigee.operators.sampling import smote, three_way_split
from perigee.operators.scoring import apply_model
from perigee.session import cut_lineage
from perigee.spec import FeatureSpec

RUN_SCHEMA = (
    "run_id string, start_time timestamp, params map<string,string>, metrics map<string,double>, model_path string"
)
# Display names, display order and reported metrics.
MODEL_DISPLAY = {
    "logistic_regression": "Logistic Regression", "decision_tree": "Decision Tree", "random_forest": "Random Forest",
    "linear_svc": "Linear SVC",
}
REPORTED = ("recall", "precision", "f1", "pr_auc", "roc_auc")
ROW_KEY = "row_key"


@dataclass
class ExperimentResult:
    model_name: str
    best_params: dict = field(default_factory=dict)
    val_metrics: dict = field(default_factory=dict)
    test_metrics: dict = field(default_factory=dict)
    model: PipelineModel | None = None


def sample_candidates(space: Mapping[str, Sequence], n_iter: int, seed: int) -> list[dict]:
    """Seeded draw of distinct parameter sets; all of them when the space is no larger than ``n_iter``."""
    grid = [dict(zip(space, values)) for values in product(*space.values())]
    return random.Random(seed).sample(grid, min(n_iter, len(grid)))


def _metrics_of(model: PipelineModel, frame: DataFrame, spec: FeatureSpec) -> dict:
    scored = apply_model(_numeric(frame, spec), model, spec).select(
        F.col(spec.target).cast("int").alias("y"), "pred", "prob"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return compute_metrics(scored, "y", "pred", "prob").first().asDict()
    finally:
        scored.unpersist()


def _numeric(frame: DataFrame, spec: FeatureSpec) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("double") for c in [spec.target, *spec.features]})


def resampled_train(split: DataFrame, spec: FeatureSpec, k: int = 5, seed: int = SEED) -> DataFrame:
    """Balanced training frame with a text row key for hash folds.

    Checkpointed: every step of an iterative fit is a job over this frame, and a short lineage keeps its tasks small.
    """
    balanced = smote(split.filter("split = 'train'"), spec, k=k, seed=seed)
    return cut_lineage(_numeric(balanced, spec))


def sized(frame: DataFrame, n_rows: int, per_partition: int = 50_000) -> DataFrame:
    """Fewer partitions for a small frame: iterative fits start one job per step, so tiny tasks would dominate."""
    return frame.coalesce(max(1, -(-n_rows // per_partition)))


@dataclass
class Candidate:
    params: dict
    model: PipelineModel
    val_metrics: dict


def fit_candidates(
    train: DataFrame, val: DataFrame, spec: FeatureSpec, model: str, n_rows: int, n_iter: int, seed: int, parallelism: int = 4
) -> list[Candidate]:
    """Fitted parameter sets with their validation metrics; the defaults alone for a model without a search space."""
    space = PARAM_SPACES.get(model, {})

    def fit(params: dict) -> Candidate:
        fitted = make_pipeline(model, spec, n_rows, key=ROW_KEY, **params).fit(train)
        return Candidate(used_params(model, params), fitted, _metrics_of(fitted, val, spec))

    drawn = sample_candidates(space, n_iter, seed)
    with ThreadPool(max(1, min(parallelism, len(drawn)))) as pool:
        return pool.map(fit, drawn, chunksize=1)


def run_experiment(
    split: DataFrame, spec: FeatureSpec, model: str, n_iter: int = 10, seed: int = SEED, train: DataFrame | None = None,
) -> ExperimentResult:
    """One model on one split: the candidate with the best validation PR-AUC, the first of equals, meets the test rows once.

    A fit depends on frame, parameters and seed alone, so the winner is kept and not fitted again.
    """
    if train is None:
        train = resampled_train(split, spec, seed=seed)
    n_rows = train.count()
    found = fit_candidates(sized(train, n_rows), split.filter("split = 'val'"), spec, model, n_rows, n_iter, seed)
    best = max(found, key=lambda c: c.val_metrics["pr_auc"])
    test_metrics = _metrics_of(best.model, split.filter("split = 'test'"), spec)
    return ExperimentResult(model, best.params, best.val_metrics, test_metrics, best.model)


def average_precision(df: DataFrame, label: str, score: str) -> float:
    """Step-wise average precision: precision at each threshold weighted by the recall gained there."""
    points = curve_points(df, label, score)
    return points.agg(F.sum(F.col("recall_gain") * F.col("precision"))).first()[0] or 0.0


def cross_validated_search(
    train: DataFrame, spec: FeatureSpec, model: str, n_iter: int = 30, folds: int = 5, seed: int = SEED
) -> tuple[dict, float]:
    """Earlier search: average precision over hash folds of the *resampled* train frame.

    Synthetic rows leak between folds, so the score is inflated; kept for comparison only.
    """
    folded = train.withColumn("_cv", F.pmod(F.xxhash64(ROW_KEY, F.lit(seed)), F.lit(folds)))
    n_rows = train.count()
    best: tuple[dict, float] = ({}, -1.0)
    for params in sample_candidates(PARAM_SPACES[model], n_iter, seed):
        total = 0.0
        for i in range(folds):
            fitted = make_pipeline(model, spec, n_rows, key=ROW_KEY, **params).fit(folded.filter(F.col("_cv") != i))
            scored = apply_model(folded.filter(F.col("_cv") == i), fitted, spec)
            total += average_precision(scored, spec.target, "prob")
        if total / folds > best[1]:
            best = (params, total / folds)
    return best


def log_run(
    spark: SparkSession, runs_path: str, result: ExperimentResult, params: Mapping[str, object], model_dir: str | None = None
) -> str:
    """Appends one run (params, ``val_*`` and ``test_*`` metrics, model path); returns its id."""
    run_id = uuid.uuid4().hex
    path = None
    if result.model is not None and model_dir is not None:
        path = f"{model_dir.rstrip('/')}/{run_id}"
        result.model.write().overwrite().save(path)
    values = {"model_name": result.model_name, **params, **{f"best_param__{k}": v for k, v in result.best_params.items()}}
    metrics = {
        f"{prefix}_{name}": float(source[name])
        for prefix, source in (("val", result.val_metrics), ("test", result.test_metrics))
        for name in METRIC_FIELDS if source and source.get(name) is not None
    }
    row = spark.createDataFrame(
        [(run_id, {k: str(v) for k, v in values.items()}, metrics, path)],
        "run_id string, params map<string,string>, metrics map<string,double>, model_path string",
    ).withColumn("start_time", F.current_timestamp())
    row.select("run_id", "start_time", "params", "metrics", "model_path").write.mode("append").parquet(runs_path)
    return run_id


def run_grid(
    spark: SparkSession, df: DataFrame, specs: Mapping[str, FeatureSpec], runs_path: str, dataset: str, n_iter: int = 10,
    seed: int = SEED, models: Sequence[str] = ALL_MODELS, model_dir: str | None = None, parallelism: int = 4,
) -> DataFrame:
    """Every feature set with every model. Split and balanced train frame are made and stored once per feature set.

    ``parallelism`` runs are under way at a time, each in a scheduler pool and job group of its own, so the many short
    jobs of the fits fill the executors and none starves the others where the scheduler is fair. A run that fails takes
    its own jobs down and the grid with it; runs that were logged before stay.
    """
    tasks = []
    for name, spec in specs.items():
        split = cut_lineage(three_way_split(df, spec.id, spec.target, salt=f"_split_{seed}"))
        sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
        train = resampled_train(split, spec, seed=seed)
        # The slowest models first, so that short ones fill the end.
        tasks += [(name, spec, model, split, sizes, train) for model in models]
    tasks.sort(key=lambda t: t[2] != "random_forest")
    sc = spark.sparkContext

    def run(task: tuple) -> None:
        name, spec, model, split, sizes, train = task
        group = f"grid-{name}-{model}-{uuid.uuid4().hex}"
        sc.setLocalProperty("spark.scheduler.pool", f"grid-{name}-{model}")
        sc.setJobGroup(group, f"{model} on {name}", interruptOnCancel=False)
        try:
            result = run_experiment(split, spec, model, n_iter, seed, train)
        except Exception:
            sc.cancelJobGroup(group)
            raise
        log_run(spark, runs_path, result, {
            "feature_set": name, "dataset": dataset, "n_iter": n_iter, "random_state": seed,
            **{f"n_{k}": v for k, v in sizes.items()},
        }, model_dir)

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        pool.map(run, tasks, chunksize=1)
    return spark.read.schema(RUN_SCHEMA).parquet(runs_path)


def latest_runs(runs: DataFrame, by: Sequence[str] = ("feature_set", "model_name")) -> DataFrame:
    """Last run per combination of parameters, by start time then run id. Combined on the map side, no sort."""
    keyed = runs.withColumns({f"_k_{p}": F.col("params")[p] for p in by})
    row = F.struct(*runs.columns)
    latest = keyed.groupBy(*[f"_k_{p}" for p in by]).agg(F.max_by(row, F.struct("start_time", "run_id")).alias("r"))
    return latest.select("r.*")


def results_table(runs: DataFrame, dataset: str) -> DataFrame:
    """Latest test metrics per feature set and model, in display order, three decimals."""
    latest = latest_runs(runs.filter(F.col("params")["dataset"] == dataset))
    order = F.lit(len(ALL_MODELS))
    shown = F.col("params")["model_name"]
    for i, m in enumerate(ALL_MODELS):
        order = F.when(F.col("params")["model_name"] == m, F.lit(i)).otherwise(order)
        shown = F.when(F.col("params")["model_name"] == m, F.lit(MODEL_DISPLAY[m])).otherwise(shown)
    out = latest.select(
        F.col("params")["feature_set"].alias("feature_set"), shown.alias("model"), order.alias("_order"),
        *[F.round(F.col("metrics")[f"test_{m}"], 3).alias(m) for m in REPORTED],
    )
    return out.orderBy("feature_set", "_order", "model").drop("_order")


def champion(runs: DataFrame, selector: Mapping[str, str]) -> DataFrame:
    """The latest run whose params match the selector."""
    matching = runs
    for k, v in selector.items():
        matching = matching.filter(F.col("params")[k] == v)
    return matching.orderBy(F.desc("start_time"), F.desc("run_id")).limit(1)


def export_champion(runs: DataFrame, selector: Mapping[str, str], path: str) -> PipelineModel:
    """Copies the champion's pipeline to ``path``; an absent run or an empty export is an error."""
    row = champion(runs, selector).first()
    if row is None:
        raise LookupError(f"no run matches {dict(selector)}")
    if not row["model_path"]:
        raise LookupError(f"run {row['run_id']} has no stored model")
    PipelineModel.load(row["model_path"]).write().overwrite().save(path)
    exported = PipelineModel.load(path)
    if not exported.stages:
        raise RuntimeError(f"export of run {row['run_id']} is empty")
    return exported
