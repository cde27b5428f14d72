import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.operators import cluster, graph


def kruskal(edges):
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    out = []
    for w, a, b in sorted((w, a, b) for a, b, w in edges):
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b, w))
    labels = {}
    for v in list(parent):
        labels.setdefault(find(v), []).append(v)
    return sorted(out), {v: min(vs) for vs in labels.values() for v in vs}


@pytest.fixture(scope="module")
def random_graph(spark):
    rng = np.random.default_rng(11)
    pairs = {(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 120, size=(150, 2)) if a != b}
    edges = [(a, b, float(rng.integers(1, 6))) for a, b in sorted(pairs)]
    return spark.createDataFrame(edges, "src bigint, dst bigint, w double"), edges


def test_spanning_forest_equals_kruskal(random_graph):
    df, edges = random_graph
    assert sorted(map(tuple, graph.spanning_forest(df).collect())) == kruskal(edges)[0]


def test_components_of_several_graphs_at_once(random_graph):
    df, edges = random_graph
    both = df.withColumn("g", F.lit(0)).unionByName(df.filter("w <= 2").withColumn("g", F.lit(1)))
    got = graph.components(both, ["g"]).collect()
    assert {r["v"]: r["c"] for r in got if r["g"] == 0} == kruskal(edges)[1]
    assert {r["v"]: r["c"] for r in got if r["g"] == 1} == kruskal([e for e in edges if e[2] <= 2])[1]


def test_communities_find_two_cliques(spark):
    def clique(first):
        return [(a, b) for a in range(first, first + 6) for b in range(a + 1, first + 6)]

    edges = spark.createDataFrame(clique(0) + clique(6) + [(5, 6)], "src bigint, dst bigint")
    labels = graph.communities(edges)
    sides = {r["v"]: r["c"] for r in labels.collect()}
    assert len({sides[v] for v in range(6)}) == 1 and len(set(sides.values())) == 2
    found = graph.modularity(edges.withColumn("w", F.lit(1.0)), labels).first()[0]
    assert found == pytest.approx(30 / 31 - 0.5)


def test_communities_without_edges(spark):
    assert graph.communities(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    parts = [rng.normal(c, 0.3, (60, 2)) for c in ([0, 0], [6, 6], [0, 7])] + [rng.uniform(-30, 40, (12, 2))]
    rows = [(i, [float(v) for v in p], min(i // 60, 3)) for i, p in enumerate(np.vstack(parts))]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, t int")


def test_density_clusters_find_blobs_and_noise(blobs):
    rows = cluster.density_clusters(blobs, "id", "vec", min_size=10, levels=12).collect()
    found = [{r["density"] for r in rows if r["t"] == t and r["density"] != -1} for t in range(3)]
    assert all(len(f) == 1 for f in found) and len(set.union(*found)) == 3
    assert sum(r["density"] == -1 for r in rows if r["t"] < 3) < 20
    assert sum(r["density"] == -1 for r in rows if r["t"] == 3) > 6


def test_too_few_rows_are_all_noise(blobs):
    rows = cluster.density_clusters(blobs.limit(5), "id", "vec", min_size=10, levels=4).collect()
    assert {r["density"] for r in rows} == {-1}


def test_kmeans_and_comparison(blobs):
    labelled = cluster.kmeans_best_of(cluster.scale_features(
        blobs.filter("t < 3").select("id", "t", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y")), ["x", "y"]
    ), "vec", k=3, n_init=2)
    row = cluster.compare(labelled, "t", {"kmeans": "kmeans"}).first()
    assert row["n_clusters_found"] == 3 and row["ari"] == pytest.approx(1.0) and row["noise_fraction"] == 0.0
