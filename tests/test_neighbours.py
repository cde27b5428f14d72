import numpy as np
import pytest

from perigee.operators import neighbours as nb


def brute(points, ids, k):
    dist = np.sqrt(((points[:, None, :] - points[None]) ** 2).sum(-1))
    np.fill_diagonal(dist, np.inf)
    return {
        ids[i]: [ids[j] for j in np.lexsort((ids, dist[i]))[:k] if np.isfinite(dist[i][j])] for i in range(len(points))
    }


def as_lists(edges):
    out = {}
    for r in sorted(edges.collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append(r["nbr"])
    return out


# Integer coordinates keep distances exact, so that ties are real ties; a third of the rows share one vector.
@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-20, 20, size=(900, 3)).astype(float)
    x[:300] = x[0]
    ids = np.arange(900) * 7 % 6301
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "i bigint, v array<double>")
    return df, x, ids


@pytest.mark.parametrize("cell_rows,block", [(2000, 2048), (40, 2048), (100, 16)])
def test_neighbours_equal_brute_force(points, monkeypatch, cell_rows, block):
    df, x, ids = points
    monkeypatch.setattr(nb, "BLOCK_ROWS", block)
    assert as_lists(nb.knn_join(df, "i", "v", 4, cell_rows=cell_rows)) == brute(x, ids, 4)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [1.0])], "i bigint, v array<double>")
    assert as_lists(nb.knn_join(df, "i", "v", 5)) == {1: [2, 3], 2: [3, 1], 3: [2, 1]}


def test_graph_is_simple(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 2), (3, 1)], "id bigint, nbr bigint")
    assert sorted(map(tuple, nb.knn_graph(edges).collect())) == [(1, 2), (1, 3)]


def test_no_cartesian_product(points):
    df, _, _ = points
    plan = nb.knn_join(df, "i", "v", 4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_row_travels_to_blocks_and_not_to_each_cell(spark, monkeypatch):
    """In many dimensions nothing can be excluded: a copy of the vector for each of 60 cells took the executors' memory."""
    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(600, 40)), np.arange(600)
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "i bigint, v array<double>")
    seen, meetings = [], nb._meetings
    monkeypatch.setattr(nb, "_meetings", lambda rows, n, meet: (seen.append((rows.count(), n)), meetings(rows, n, meet))[1])
    assert as_lists(nb.knn_join(df, "i", "v", 5, cell_rows=10)) == brute(x, ids, 5)
    (own, blocks), (sent, pairs) = seen
    assert own == 600 and 1 < blocks < 15 and sent <= 600 * (blocks - 1) and pairs <= blocks * (blocks - 1) // 2


def test_equal_distances_are_reduced_as_they_come(spark, monkeypatch):
    """All distances equal: every pair passes the screen, and the smallest keys remain."""
    monkeypatch.setattr(nb, "PENDING", 500)
    monkeypatch.setattr(nb, "TILE_ROWS", 7)
    monkeypatch.setattr(nb, "TILE_COLUMNS", 11)
    x, ids = np.eye(90), np.arange(90) * 11 % 97
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "i bigint, v array<double>")
    assert as_lists(nb.knn_join(df, "i", "v", 4, cell_rows=10)) == brute(x, ids, 4)


def test_a_vector_that_is_no_number_hides_no_others(spark):
    rng = np.random.default_rng(7)
    x, ids = rng.integers(-9, 9, size=(300, 2)).astype(float) * 7.25, np.arange(300)
    x[::60] = [[float("nan"), 1.0], [float("inf"), 2.0], [3.0, float("-inf")], [4.0, float("nan")], [1e200, 1e200]]
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "i bigint, v array<double>")
    near = as_lists(nb.knn_join(df.filter("not isnan(v[0]) and not isnan(v[1])"), "i", "v", 3, cell_rows=20))
    found = as_lists(nb.knn_join(df, "i", "v", 3, cell_rows=20))
    assert found == near and len(found) == 295


def test_large_offsets_are_not_lost_in_rounding(spark):
    rng = np.random.default_rng(8)
    x, ids = rng.normal(size=(400, 6)) * 1e-3 + 1e6, np.arange(400)
    df = spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x)], "i bigint, v array<double>")
    assert as_lists(nb.knn_join(df, "i", "v", 6, cell_rows=25)) == brute(x, ids, 6)
