import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.operators import cluster, hierarchy
from perigee.operators.distributed import global_rank


def brute_merges(edges):
    """Merges of a forest one by one: (w, small, large, label, parent place)."""
    up, size, label, top, out = {}, {}, {}, {}, []

    def find(v):
        while up.setdefault(v, v) != v:
            v = up[v]
        return v

    for i, (w, a, b) in enumerate(sorted((w, a, b) for a, b, w in edges)):
        a, b = find(a), find(b)
        sa, sb = size.get(a, 1), size.get(b, 1)
        out.append([w, min(sa, sb), max(sa, sb), min(label.get(a, a), label.get(b, b)), None, (top.get(a), top.get(b), a, b)])
        for v in (a, b):
            if v in top:
                out[top[v]][4] = i
        up[a] = b
        size[b], label[b], top[b] = sa + sb, out[-1][3], i
    return out


def brute_labels(edges, min_size):
    """Condensed tree and stable clusters by recursion over the merges, straight from their definition."""
    merges = brute_merges(edges)
    least = min([m[0] for m in merges if m[0] > 0], default=1.0)
    density = lambda i: 1 / max(merges[i][0], least)
    total = lambda i: merges[i][1] + merges[i][2]
    vertices = {}
    first = {}
    for i, (w, a, b) in enumerate(sorted((w, a, b) for a, b, w in edges)):
        first.setdefault(a, i), first.setdefault(b, i)
    for v, i in first.items():
        while i is not None and total(i) < min_size:
            i = merges[i][4]
        if i is not None:
            vertices.setdefault(i, []).append(v)
    children = {}
    for i, m in enumerate(merges):
        if m[4] is not None:
            children.setdefault(m[4], []).append(i)

    def cluster_from(i, birth, is_root):
        """(value, labels) of the cluster whose heaviest merge is i."""
        name, own, held, born = merges[i][3], 0.0, [], []
        while True:
            here = vertices.get(i, [])
            held += here
            big = [c for c in children.get(i, []) if total(c) >= min_size]
            if len(big) == 2:
                own += total(i) * (density(i) - birth)
                born = [cluster_from(c, density(i), False) for c in big]
                break
            own += len(here) * (density(i) - birth)
            if not big:
                break
            i = big[0]
        below = sum(v for v, _, _ in born)
        everyone = held + [v for _, _, all_ in born for v in all_]
        if not born or (not is_root and own >= below):
            return own, dict.fromkeys(everyone, name), everyone
        return below, {v: c for _, labels, _ in born for v, c in labels.items()}, everyone

    out = {}
    for i, m in enumerate(merges):
        if m[4] is None and total(i) >= min_size:
            out |= cluster_from(i, 0.0, True)[1]
    return out


def random_forest(seed, n, ties):
    rng = np.random.default_rng(seed)
    names = rng.permutation(n * 3)[:n]
    edges = []
    for i in range(1, n):
        if i % 97 == 0:
            continue  # a new tree
        j = int(rng.integers(max(0, i - int(rng.choice([1, 5, n]))), i))
        w = float(rng.integers(0, 8)) if ties else float(rng.gamma(1.0 + 3 * (i % 50 == 0)))
        edges.append((int(names[i]), int(names[j]), w))
    return [(min(a, b), max(a, b), w) for a, b, w in edges]


def frame(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint, w double")


@pytest.mark.parametrize(("seed", "n", "ties", "block"), [(1, 150, False, 1 << 16), (2, 300, True, 16), (3, 400, False, 7)])
def test_merges_and_labels_at_any_block(spark, seed, n, ties, block):
    edges = random_forest(seed, n, ties)
    merges, firsts = hierarchy.merge_tree(frame(spark, edges), block)
    got = {r["rank"]: (r["w"], r["small"], r["large"], r["label"], r["parent"]) for r in merges.collect()}
    assert got == {i: tuple(m[:5]) for i, m in enumerate(brute_merges(edges))}
    assert firsts.count() == len({v for a, b, _ in edges for v in (a, b)})
    clusters, owner = hierarchy.condense(merges, 8)
    labels = {r["v"]: r["label"] for r in hierarchy.hierarchy_labels(frame(spark, edges), 8, block).collect()}
    assert labels == brute_labels(edges, 8)


def test_long_chain_of_merges(spark):
    edges = [(i, i + 1, float(i + 1)) for i in range(700)]
    assert {r["v"]: r["label"] for r in hierarchy.hierarchy_labels(frame(spark, edges), 5).collect()} == brute_labels(edges, 5)


def test_values_of_a_deep_tree(spark):
    rng = np.random.default_rng(4)
    parent = {0: None} | {i: int(i - 1 if i % 3 else rng.integers(0, i)) for i in range(1, 250)}
    own = {i: float(rng.integers(1, 40)) for i in parent}
    value = dict.fromkeys(parent, 0.0)
    for i in sorted(parent, reverse=True):
        value[i] = max(own[i], value[i])
        if parent[i] is not None:
            value[parent[i]] += value[i]
    df = spark.createDataFrame([(i, p, own[i]) for i, p in parent.items()], "c bigint, pc bigint, own double")
    assert {r["c"]: r["value"] for r in hierarchy.best_values(df).collect()} == value


def test_no_edges_and_small_trees(spark):
    assert hierarchy.hierarchy_labels(frame(spark, []), 3).collect() == []
    assert hierarchy.hierarchy_labels(frame(spark, [(1, 2, 0.0), (5, 6, 1.0)]), 3).collect() == []
    same = [(i, i + 1, 0.0) for i in range(9)]
    assert {r["v"]: r["label"] for r in hierarchy.hierarchy_labels(frame(spark, same), 3).collect()} == dict.fromkeys(range(10), 0)


def test_density_clusters_of_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    forest = cluster.mutual_reachability_forest(rows, "vec_id", "vec", 10)
    want = brute_labels([(r["src"], r["dst"], r["w"]) for r in forest.collect()], 10)
    got = {r["vec_id"]: r["density"] for r in cluster.density_clusters(rows, "vec_id", "vec", 10).collect()}
    assert {v: c for v, c in got.items() if c != -1} == want and len(got) == rows.count()


def test_global_rank(spark):
    rng = np.random.default_rng(8)
    rows = [(float(w), i) for i, w in enumerate(rng.integers(0, 5, 500))]
    got = global_rank(spark.createDataFrame(rows, "w double, i bigint"), ["w", "i"], "place").collect()
    assert [(r["w"], r["i"]) for r in sorted(got, key=lambda r: r["place"])] == sorted(rows) and max(r["place"] for r in got) == 500
