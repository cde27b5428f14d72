import random

import pytest
from pyspark.sql import functions as F

from perigee.operators import sampling
from perigee.spec import WITHOUT_MOID, FeatureSpec


@pytest.fixture(scope="module")
def population(spark):
    """20,000 rows, 44 positives."""
    rng = random.Random(7)
    rows = [(i, i < 44, rng.random(), rng.uniform(0, 5), rng.uniform(5, 25), rng.randint(0, 1), rng.randint(0, 12))
            for i in range(20_000)]
    return spark.createDataFrame(
        rows, "spkid bigint, is_pha boolean, e double, q double, H double, is_neo int, class_code int"
    ).cache()


@pytest.fixture(scope="module")
def split(population):
    return sampling.three_way_split(population, "spkid", "is_pha").cache()


def test_split_sizes_ratio_and_disjointness(split):
    rows = {r["split"]: r for r in sampling.check_splits(split, "spkid", "is_pha").collect()}
    assert {k: r["n"] for k, r in rows.items()} == pytest.approx({"train": 12_000, "val": 4_000, "test": 4_000}, abs=5)
    assert sum(r["n"] for r in rows.values()) == 20_000
    for r in rows.values():
        assert r["positives"] / r["n"] == pytest.approx(44 / 20_000, abs=0.001)
        assert r["shared_keys"] == 0


def test_two_way_split(population):
    out = sampling.three_way_split(population, "spkid", "is_pha", val=0.0, test=0.2)
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 16_000, "test": 4_000}


def test_samples_have_exact_sizes(population):
    got = sampling.stratified_sample(population, "spkid", "is_pha", 5_000, "s")
    assert got.count() == 5_000 and got.filter("is_pha").count() == 11
    assert sampling.uniform_sample(population, "spkid", 77, "s").count() == 77
    assert sampling.uniform_sample(population, "spkid", 10**6, "s").count() == 20_000


def test_balanced_train_and_untouched_rest(split):
    train = split.filter("split = 'train'")
    out = sampling.smote(train, WITHOUT_MOID).cache()
    counts = {(r["is_pha"], r["synthetic"]): r["count"] for r in out.groupBy("is_pha", "synthetic").count().collect()}
    positives = train.filter("is_pha").count()
    negatives = train.count() - positives
    assert counts == {(0, False): negatives, (1, False): positives, (1, True): negatives - positives}
    assert out.select("row_key").distinct().count() == 2 * negatives
    # Nominal values are copied from a real row.
    assert out.filter("synthetic and class_code != floor(class_code)").count() == 0


def test_synthetic_rows_lie_between_minority_rows(spark):
    spec = FeatureSpec("id", "y", ("a", "b"))
    rows = [(0, 0.0, 0.0), (1, 1.0, 1.0), (2, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double")
    out = sampling.smote_rows(df, spec, 50, nominal="interpolate").collect()
    assert len(out) == 50 and len({r["copy"] for r in out}) == 50
    for r in out:
        assert r["a"] == pytest.approx(r["b"]) and 0 <= r["a"] <= 2
    used = [sum(r["base_id"] == i for r in out) for i in range(3)]
    assert max(used) - min(used) <= 1


def test_oversampling_needs_two_minority_rows_and_two_classes(spark):
    spec = FeatureSpec("id", "y", ("a",))
    one = spark.createDataFrame([(0, 1, 0.0), (1, 0, 1.0), (2, 0, 1.0)], "id bigint, y int, a double")
    with pytest.raises(ValueError):
        sampling.smote(one, spec).count()
    with pytest.raises(ValueError):
        sampling.smote(one.filter("y = 0"), spec)
    assert sampling.smote(one.filter("id < 2"), spec).count() == 2
    with pytest.raises(ValueError):
        sampling.smote_rows(one, spec, 1, nominal="other")


def test_fixture_keeps_edge_rows(population):
    out = sampling.fixture_sample(population, "spkid", "is_pha", {True: 3, False: 17}, "f", F.col("spkid") >= 19_996)
    assert out.count() == 24 and out.filter("spkid >= 19996").count() == 4
