import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.llm import vectors
from perigee.llm.vectors import near_vectors, op10_epsilon_grid

SCHEMA = "vec_id bigint, embedding array<float>, label int, cid int, vec string, `key` int"


def brute(rows, cosine):
    """(links, component) by all pairs; rows are (id, vector or None, label)."""
    usable = [v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    near = np.zeros((len(rows), len(rows)), bool)
    groups = {}
    for i, (_, v, label) in enumerate(rows):
        if usable[i]:
            groups.setdefault((label, len(v)), []).append(i)
    for at in groups.values():
        x = np.array([rows[i][1] for i in at], np.float32).astype(np.float64)
        n = np.linalg.norm(x, axis=1)
        near[np.ix_(at, at)] = (x @ x.T) / np.outer(n, n) >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(rows)).min(axis=1, initial=len(rows)))
        if (new == label).all():
            break
        label = new
    names = {}
    for i, g in enumerate(label):
        if rows[i][0] is not None:
            names[g] = min(names.get(g, rows[i][0]), rows[i][0])
    return [(int(near[i].sum()), names.get(g)) for i, g in enumerate(label)]


def test_query(spark, sf):
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect())
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op10_epsilon_grid(spark, sf).collect()}
    for row, (links, first) in zip(rows, brute(rows, 0.98)):
        assert got[row[0]] == (links, first, row[0] == first)


@pytest.mark.parametrize("block", [16, 1024])
def test_clusters_chains_and_copies(spark, monkeypatch, block):
    """Many small blocks and levels of intervals; dense groups, chains, equal vectors and odd ones."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [centre + rng.normal(size=8) * rng.choice([0.02, 0.08, 0.15]) for _ in range(30)]
    angle = np.arange(60) * 0.15
    rows += [np.array([np.cos(a), np.sin(a), 0, 0, 0, 0, 0, 0]) for a in angle] + [rows[0]] * 20
    rows = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 0), (n + 3, [None] + [1.0] * 7, 0), (n + 4, rows[0][1], None), (n + 5, [], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (None, [3.0, 6.0], 1)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0), (r["n_links"], r["component_id"])) for r in near_vectors(df, 0.98).collect())
    assert got == sorted(((r[0] is None, r[0] or 0), b) for r, b in zip(rows, brute(rows, 0.98)))


def test_distant_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, (np.eye(8)[i % 8] * 10 + rng.normal(size=8) * 0.1).tolist(), 1) for i in range(800)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>, label int")
    classes = vectors.parsed_vectors(df, "id", "vec", "label").groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("copies"))
    blocks = vectors.store(vectors.grid_blocks(vectors.store(classes.withColumn("cid", F.monotonically_increasing_id())), 0.2, 4))
    pairs = vectors.near_block_pairs(blocks.select("block", "label", "lo", "hi"), 0.2 + vectors.SLACK).count()
    n = blocks.count()
    assert n >= 50 and n <= pairs < n * (n + 1) / 2 / 3


def test_no_rows(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA), 0.98).collect() == []
