import numpy as np
import pytest
from pyspark.sql import functions as F

from perigee.operators import distributed as d


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all values are one number."""
    rng = np.random.default_rng(3)
    x = rng.exponential(size=3000)
    x[:1000] = 0.7
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id bigint, x double"), x


@pytest.mark.parametrize("small,inside,accuracy", [(10_000, 1, 10_000), (0, 10_000, 10_000), (0, 10_000, 20), (0, 3, 20)])
def test_exact_percentiles_match_interpolation(skewed, monkeypatch, small, inside, accuracy):
    monkeypatch.setattr(d, "APPROX_ACCURACY", accuracy)
    df, x = skewed
    qs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = d.exact_percentiles(df, ["x"], qs, small=small, inside=inside)["x"]
    assert got == pytest.approx(list(np.quantile(x, qs)), abs=1e-12)


def test_percentiles_of_nothing_are_null(skewed):
    df, _ = skewed
    assert d.exact_percentiles(df.filter("x < 0"), ["x"], [0.5])["x"] == [None]


@pytest.mark.parametrize("rows", [7, 300, 10**9])
def test_running_totals_over_ranges(skewed, rows):
    df, x = skewed
    per = df.groupBy("x").agg(F.count("*").alias("n"))
    got = {r["x"]: r["cum_n"] for r in d.running_totals(per, "x", ["n"], descending=False, range_rows=rows).collect()}
    values, counts = np.unique(x, return_counts=True)
    assert got == dict(zip(values.tolist(), np.cumsum(counts).tolist()))


@pytest.mark.parametrize("descending", [True, False])
def test_null_keys_come_last_for_any_range(spark, descending):
    rows = [(None, 5), *[(float(i), i % 3 + 1) for i in range(200)]]
    df = spark.createDataFrame(rows, "x double, n long")
    got = [
        {r["x"]: (r["cum_n"], r["total_n"]) for r in d.running_totals(df, "x", ["n"], descending, range_rows=rr).collect()}
        for rr in (3, 50, 10**9)
    ]
    total = sum(n for _, n in rows)
    assert got[0] == got[1] == got[2] and got[0][None] == (total, total)
    first = 199.0 if descending else 0.0
    assert got[0][first] == (2 if descending else 1, total)


@pytest.mark.parametrize("n_rows", [10, 10**9])
def test_hash_rank_is_a_permutation_for_any_bucket_count(skewed, n_rows):
    df, _ = skewed
    base = df.withColumn("g", F.col("id") % 3)
    got = d.hash_rank(base, ["g"], "id", "s", n_rows=n_rows).select("id", "g", "rank").collect()
    by_hash = base.withColumn("h", d.hash_key("id", "s")).select("id", "g", "h").collect()
    for g in range(3):
        want = [r["id"] for r in sorted((r for r in by_hash if r["g"] == g), key=lambda r: (r["h"], r["id"]))]
        assert [r["id"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == want


@pytest.mark.parametrize("n_rows", [10, 10**9])
@pytest.mark.parametrize("cuts", [[0, 10], [7, 7], [100, 5000], [1000, 1000]])
def test_hash_segments_equal_ranks(spark, skewed, cuts, n_rows):
    df, _ = skewed
    base = df.withColumn("g", F.when(F.col("id") < 1000, True).otherwise(False))
    limits = spark.createDataFrame([(True, cuts), (False, cuts)], "g boolean, cuts array<bigint>")
    got = {r["id"]: r["segment"] for r in
           d.hash_segments(base, "g", "id", "s", limits, ["a", "b"], rest="c", n_rows=n_rows).collect()}
    ranks = d.hash_rank(base, ["g"], "id", "s").collect()
    assert len(got) == 3000
    for r in ranks:
        assert got[r["id"]] == ("a" if r["rank"] <= cuts[0] else "b" if r["rank"] <= cuts[1] else "c")
