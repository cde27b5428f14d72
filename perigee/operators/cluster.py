"""Unsupervised comparison: k-means, density clusters, graph communities against known classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.graph import communities, spanning_forest
from perigee.operators.hierarchy import hierarchy_labels
from perigee.operators.metrics import cluster_quality
from perigee.operators.neighbours import knn_graph, knn_join
from perigee.session import cut_lineage

N_CLASSES = 13
NOISE = -1


def scale_features(df: DataFrame, features: Sequence[str], out: str = "vec") -> DataFrame:
    """Adds the standardised features as ``array<double>``."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="_raw").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(assembled)
    return scaler.transform(assembled).withColumn(out, vector_to_array("_scaled")).drop("_raw", "_scaled")


def kmeans_best_of(df: DataFrame, vec: str, k: int = N_CLASSES, n_init: int = 10, seed: int = 42, out: str = "kmeans") -> DataFrame:
    """k-means labels from the cheapest of ``n_init`` seeded starts."""
    data = df.select(array_to_vector(vec).alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
    best = None
    for i in range(n_init):
        model = KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol=out).fit(data)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    data.unpersist()
    return best.transform(df.withColumn("features", array_to_vector(vec))).drop("features")


def community_clusters(df: DataFrame, id_col: str, vec: str, k: int = 10, out: str = "community") -> DataFrame:
    """Louvain communities of the exact k-nearest-neighbour graph. A row without neighbours is its own community."""
    labels = communities(cut_lineage(knn_graph(knn_join(df, id_col, vec, k))))
    named = labels.select(F.col("v").alias(id_col), F.col("c").alias(out))
    return df.join(named, id_col, "left").withColumn(out, F.coalesce(F.col(out), F.col(id_col)))


def mutual_reachability_forest(df: DataFrame, id_col: str, vec: str, min_size: int = 30) -> DataFrame:
    """Minimum spanning forest ``(src, dst, w)`` of the neighbour graph under mutual reachability.

    Core distance is the distance to the ``min_size``-th neighbour; an edge weighs the largest of both core distances and
    its length.
    """
    edges = cut_lineage(knn_join(df, id_col, vec, min_size))
    core = cut_lineage(edges.groupBy("id").agg(F.max("dist").alias("core")))
    weighed = (
        edges.join(core, "id").join(core.select(F.col("id").alias("nbr"), F.col("core").alias("other")), "nbr")
        .select(F.least("id", "nbr").alias("src"), F.greatest("id", "nbr").alias("dst"), F.greatest("core", "other", "dist").alias("w"))
        .distinct()
    )
    return cut_lineage(spanning_forest(weighed))


def density_clusters(df: DataFrame, id_col: str, vec: str, min_size: int = 30, out: str = "density") -> DataFrame:
    """Density clusters with noise -1 and no preset number of clusters.

    The spanning forest under mutual reachability is merged edge by edge, condensed to clusters of at least ``min_size``
    rows, and the most stable of these are chosen, none inside another (see ``hierarchy``). A cluster is named by its
    smallest key. The one approximation is that edges reach the ``min_size`` nearest neighbours only.
    """
    labels = hierarchy_labels(mutual_reachability_forest(df, id_col, vec, min_size), min_size)
    named = labels.select(F.col("v").alias(id_col), F.col("label").alias(out))
    return df.join(named, id_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(NOISE)).cast("bigint"))


def compare(df: DataFrame, truth: str, label_cols: Mapping[str, str]) -> DataFrame:
    """One result row per method: clusters found, ARI, NMI, noise share. ``label_cols`` maps method to label column."""
    return reduce(DataFrame.unionByName, [cluster_quality(df, truth, col, method) for method, col in label_cols.items()])
