"""Classifier pipelines. Every stage, scaler included, lives in one pipeline, so a saved model is complete."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.session import broadcast_if_small, cut_lineage, scratch_path
from perigee.spec import FeatureSpec

# Model names.
ALL_MODELS = ("logistic_regression", "decision_tree", "random_forest", "linear_svc")
TUNABLE_MODELS = ("decision_tree", "random_forest")
SEED = 42
# Trees without a depth limit stop at the library's ceiling.
UNLIMITED_DEPTH = 30
MAX_BINS = 1024

# Search spaces. There is no parameter for the minimum rows of a node that may be split, so it is left out.
PARAM_SPACES = {
    "decision_tree": {
        "max_depth": [2, 3, 4, 5, 6, 8, 10, None],
        "min_samples_leaf": [1, 2, 5, 10],
        "criterion": ["gini", "entropy"],
    },
    "random_forest": {
        "n_estimators": [50, 100, 150, 200],
        "max_depth": [4, 6, 8, 10, None],
        "max_features": ["sqrt", "log2", 0.3, 0.5],
        "min_samples_leaf": [1, 2, 5],
    },
}
_TREE_PARAMS = {
    "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode", "criterion": "impurity",
    "n_estimators": "numTrees", "max_features": "featureSubsetStrategy",
}


def balanced_weights(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Weight n / (2 * n_class); all ones when the classes are equal in size."""
    n = {r[0]: r[1] for r in df.groupBy(F.col(target).cast("int").alias("t")).count().collect()}
    total = sum(n.values())
    return df.withColumn(out, F.when(
        F.col(target).cast("int") == 1, F.lit(total / (2 * max(n.get(1, 0), 1)))
    ).otherwise(F.lit(total / (2 * max(n.get(0, 0), 1)))))


def squared_hinge(data: DataFrame, features: Sequence[str], sign: str, weight: str, tol: float = 1e-13, max_steps: int = 100) -> np.ndarray:
    """Weights, and last the intercept, that minimise |w|^2 / 2 + sum(weight * max(0, 1 - sign * (x w + b))^2), b in w.

    Newton steps: the loss is quadratic on the rows inside the margin, so their sums of products are its Hessian. Each step
    is one aggregation over all rows in the JVM, whose result is as large as the Hessian. A step that does not lower the
    loss is halved. ``data`` should be cached; ``sign`` is 1 or -1.
    """
    xs = [*(F.col(f"`{f}`") for f in features), F.lit(1.0)]
    d = len(xs)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        margin = sum((float(v) * x for v, x in zip(w[1:], xs[1:])), float(w[0]) * xs[0])
        inside = data.withColumn("_gap", 1 - F.col(sign) * margin).filter("_gap > 0")
        pull = F.col(weight) * F.col(sign) * F.col("_gap")
        row = inside.agg(
            F.sum(F.col(weight) * F.col("_gap") * F.col("_gap")), *[F.sum(pull * x) for x in xs],
            *[F.sum(F.col(weight) * xs[i] * xs[j]) for i, j in pairs],
        ).first()
        values = np.array([v or 0.0 for v in row])
        hessian = np.eye(d)
        for (i, j), v in zip(pairs, values[1 + d :]):
            hessian[i, j] += 2 * v
            if i != j:
                hessian[j, i] += 2 * v
        return float(w @ w / 2 + values[0]), w - 2 * values[1 : 1 + d], hessian

    w = np.zeros(d)
    loss, gradient, hessian = sums(w)
    for _ in range(max_steps):
        step = np.linalg.solve(hessian, gradient)
        slope, size = float(gradient @ step), 1.0
        if slope <= tol * (1 + abs(loss)):
            break
        while True:
            reached = sums(w - size * step)
            if reached[0] <= loss - 1e-4 * size * slope or size < 1e-6:
                break
            size /= 2
        w, (loss, gradient, hessian) = w - size * step, reached
    return w


class CalibratedLinearSVC(Estimator):
    """Linear SVM of squared hinge loss with sigmoid calibration over hash folds; the ensemble's probability is the mean.

    Per fold the SVM is fitted on the other folds, and a sigmoid on its margins over the held-out fold. Sigmoid targets
    are shrunk towards the fold's class counts, by giving each held-out row both labels with complementary weights.
    Features are standardised for the fit; the pipeline of plain stages that ``fit`` returns has the margins in terms of
    the features as they come, and one ``probability_<fold>`` column each. Folds are fitted side by side.
    """

    def __init__(self, features: Sequence[str], labelCol: str, keyCol: str, folds: int = 3, cost: float = 1.0, weightCol: str | None = None):
        super().__init__()
        self.features, self.label, self.key = list(features), labelCol, keyCol
        self.folds, self.cost, self.weight = folds, cost, weightCol

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        columns = [F.col(f"`{f}`").cast("double").alias(f) for f in self.features]
        weight = F.col(self.weight) if self.weight else F.lit(1.0)
        folded = dataset.select(
            *columns, F.col(self.label).cast("double").alias("_y"), (weight * self.cost).alias("_weight"),
            F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.folds)).alias("_fold"),
        )
        spread = folded.agg(*[f(f"`{c}`") for c in self.features for f in (F.avg, F.stddev_pop)]).first()
        mean = np.array([v or 0.0 for v in spread[0::2]])
        std = np.array([v or 1.0 for v in spread[1::2]])
        scaled = folded.select(
            *[((F.col(f"`{c}`") - float(m)) / float(s)).alias(c) for c, m, s in zip(self.features, mean, std)],
            (2 * F.col("_y") - 1).alias("_sign"), "_weight", "_fold",
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPool(self.folds) as pool:
                parts = pool.map(lambda i: self._fold(folded, scaled, mean, std, i), range(self.folds), chunksize=1)
        finally:
            scaled.unpersist()
        return PipelineModel([stage for part in parts for stage in part])

    def _fold(self, folded: DataFrame, scaled: DataFrame, mean: np.ndarray, std: np.ndarray, i: int) -> list:
        w = squared_hinge(scaled.filter(F.col("_fold") != i), self.features, "_sign", "_weight")
        own = w[:-1] / std
        terms = " + ".join(f"CAST(`{c}` AS DOUBLE) * {v!r}D" for c, v in zip(self.features, own.tolist()))
        margin = SQLTransformer(statement=f"SELECT *, {terms} + {float(w[-1] - own @ mean)!r}D AS distance_{i} FROM __THIS__")
        vector = VectorAssembler(inputCols=[f"distance_{i}"], outputCol=f"margin_{i}")
        held = vector.transform(margin.transform(folded.filter(F.col("_fold") == i)))
        y = F.col("_y")
        size = held.agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")).first()
        high = ((size["pos"] or 0) + 1) / ((size["pos"] or 0) + 2)
        low = 1 / ((size["neg"] or 0) + 2)
        share = F.when(y == 1, F.lit(high)).otherwise(F.lit(low))
        both = held.select(f"margin_{i}", F.explode(F.array(
            F.struct(F.lit(1.0).alias("target"), share.alias("share")),
            F.struct(F.lit(0.0).alias("target"), (1 - share).alias("share")),
        )).alias("t")).select(f"margin_{i}", "t.target", "t.share")
        sigmoid = LogisticRegression(
            featuresCol=f"margin_{i}", labelCol="target", weightCol="share", probabilityCol=f"probability_{i}",
            rawPredictionCol=f"sigmoid_{i}", predictionCol=f"calibrated_{i}", maxIter=100,
        ).fit(both)
        return [margin, vector, sigmoid]


def used_params(name: str, params: dict) -> dict:
    """The parameters a fit really uses: no depth limit is the ceiling."""
    return {k: UNLIMITED_DEPTH if k == "max_depth" and v is None else v for k, v in params.items()} if name in TUNABLE_MODELS else params


def make_pipeline(
    name: str, spec: FeatureSpec, n_rows: int = 1000, key: str | None = None, weight: str | None = None,
    seed: int = SEED, **params,
) -> Pipeline:
    """Unfitted pipeline. ``n_rows`` of the training frame sets the ridge strength 1/n of logistic regression."""
    if name not in ALL_MODELS:
        raise ValueError(f"unknown model {name!r}")
    if name == "linear_svc":
        return Pipeline(stages=[CalibratedLinearSVC(spec.features, spec.target, key or spec.id, weightCol=weight, **params)])
    assembler = VectorAssembler(inputCols=list(spec.features), outputCol="assembled")
    if name == "logistic_regression":
        scaler = StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True)
        last = LogisticRegression(
            featuresCol="scaled", labelCol=spec.target, maxIter=1000, regParam=1.0 / n_rows, elasticNetParam=0.0,
            standardization=False, **params,
        )
        if weight:
            last = last.setWeightCol(weight)
        return Pipeline(stages=[assembler, scaler, last])

    depth = params.pop("max_depth", 4 if name == "decision_tree" else None)
    settings = {"maxDepth": UNLIMITED_DEPTH if depth is None else depth, "maxBins": MAX_BINS, "seed": seed,
                "maxMemoryInMB": 1024}
    settings.update({_TREE_PARAMS[k]: str(v) if k == "max_features" else v for k, v in params.items()})
    if name == "decision_tree":
        last = DecisionTreeClassifier(featuresCol="assembled", labelCol=spec.target, **settings)
    else:
        settings.setdefault("numTrees", 100)
        settings.setdefault("featureSubsetStrategy", "sqrt")
        last = RandomForestClassifier(featuresCol="assembled", labelCol=spec.target, **settings)
    if weight:
        last = last.setWeightCol(weight)
    return Pipeline(stages=[assembler, last])


def feature_importances(model: PipelineModel, spec: FeatureSpec, spark) -> DataFrame:
    """(feature, importance) of a tree model, most important first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(spec.features, map(float, values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_rules(model: PipelineModel, spec: FeatureSpec) -> str:
    """Readable split rules with feature names."""
    text = model.stages[-1].toDebugString
    for i in reversed(range(len(spec.features))):
        text = text.replace(f"feature {i} ", f"{spec.features[i]} ")
    return text


def tree_nodes(model: PipelineModel, spec: FeatureSpec, spark) -> DataFrame:
    """Nodes of a decision tree or forest: (tree, node, feature, threshold, low, high, prediction, rows).

    A row goes to ``low`` when its feature is at most the threshold, else to ``high``; both are null at a leaf, as are
    feature and threshold. Read from the stored form of the model, so a large forest never passes the driver.
    """
    path = scratch_path(spark, "trees")
    model.stages[-1].write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        stored = stored.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        stored = stored.withColumn("tree", F.lit(0))
    names = F.array(*[F.lit(f) for f in spec.features])
    inner = F.col("leftChild") >= 0
    return stored.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.element_at(names, F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("low"), F.when(inner, F.col("rightChild")).alias("high"), "prediction", F.col("rawCount").alias("rows"),
    )


def rule_table(nodes: DataFrame) -> DataFrame:
    """(tree, node, rule, depth, prediction, rows): the conditions from the root to every leaf, joined by AND; an only node's rule is true.

    Paths are joined upwards a level at a time, for all leaves of all trees at once.
    """
    steps = nodes.filter("low is not null")
    above = steps.select("tree", F.col("low").alias("at"), F.col("node").alias("up"), F.concat_ws(" <= ", "feature", F.col("threshold").cast("string")).alias("test")).unionByName(
        steps.select("tree", F.col("high").alias("at"), F.col("node").alias("up"), F.concat_ws(" > ", "feature", F.col("threshold").cast("string")).alias("test")))
    above = cut_lineage(above)
    state = nodes.filter("low is null").select("tree", "node", F.col("node").alias("at"), F.lit("").alias("rule"), F.lit(0).alias("depth"), "prediction", "rows")
    while True:
        further = cut_lineage(state.join(above, ["tree", "at"], "left").select(
            "tree", "node", F.coalesce("up", "at").alias("at"),
            F.when(F.col("up").isNull(), F.col("rule")).when(F.col("rule") == "", F.col("test")).otherwise(F.concat_ws(" AND ", "test", "rule")).alias("rule"),
            (F.col("depth") + F.col("up").isNotNull().cast("int")).alias("depth"), "prediction", "rows", F.col("up").isNotNull().alias("moved"),
        ))
        state = further.drop("moved")
        if further.filter("moved").isEmpty():
            return state.select("tree", "node", F.when(F.col("rule") == "", "true").otherwise(F.col("rule")).alias("rule"), "depth", "prediction", "rows")


def walk_rules(df: DataFrame, nodes: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """(id, tree, node): the leaf of every tree that each row falls into, one join with the nodes a level."""
    trees = nodes.select("tree").distinct()
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.col(f"`{f}`").cast("double"))])
    state = df.select(F.col(id_col), values.alias("_values")).join(F.broadcast(trees), F.lit(True))  # a forest has few trees
    state = state.withColumn("node", F.lit(0))
    inner = nodes.filter("low is not null").select("tree", "node", "feature", "threshold", "low", "high")
    inner = broadcast_if_small(cut_lineage(inner))
    while True:
        lower = F.col("_values")[F.col("feature")] <= F.col("threshold")
        moved = cut_lineage(state.join(inner, ["tree", "node"], "left").select(
            id_col, "_values", "tree", F.when(F.col("low").isNull(), F.col("node")).when(lower, F.col("low")).otherwise(F.col("high")).alias("node"),
            F.col("low").isNotNull().alias("moved"),
        ))
        state = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return state.select(id_col, "tree", "node")
