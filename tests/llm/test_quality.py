import zlib

import numpy as np
from pyspark.sql import functions as F

from perigee.llm.quality import N_FEATURES, document_features, features, grow, op3_boosted_trees, score_documents


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    ones = y == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op3_boosted_trees(spark, sf).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    score, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    assert len(y) > 50 and auc(score, y) > 0.95 and ((score >= 0.3) == y).mean() > 0.93


def test_trees_learn_and_walk_alike():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = grow(x, y)
    score = forest.score(x)
    assert ((score > 0.5) == y).mean() > 0.97
    one = []
    for row in x[:50]:
        total = forest.base
        for t in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
            total += forest.value[t, node - forest.feature.shape[1]]
        one.append(1 / (1 + np.exp(-total)))
    assert np.allclose(one, score[:50])
    assert np.array_equal(grow(x, y).score(x), score)


def test_labels_of_held_out_rows_are_not_used(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, score_documents(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd, nothing):
    assert len(features(b"")) == N_FEATURES and all(np.isfinite(features(b"")))
    labels = spark.createDataFrame([(4, 1), (10, 0), (7, None), (None, 1), (8, 1), (8, 0)], "doc_id bigint, quality int")
    rows = score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 < r["score"] < 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]
    assert {r["score"] for r in score_documents(odd, labels.limit(0)).collect()} == {0.5}
    assert score_documents(nothing, labels).collect() == []
    assert document_features(nothing, ["doc_id"]).collect() == []
