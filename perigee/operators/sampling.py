"""Deterministic stratified samples, splits and minority oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.distributed import hash_key, hash_rank, hash_segments
from perigee.operators.neighbours import knn_join
from perigee.session import broadcast_if_small
from perigee.spec import FeatureSpec


def uniform_sample(df: DataFrame, id_col: str, n: int, salt: str) -> DataFrame:
    """The ``n`` rows first in salted-hash order."""
    cuts = df.sparkSession.createDataFrame([(0, [n])], "_stratum int, cuts array<bigint>")
    out = hash_segments(df.withColumn("_stratum", F.lit(0)), "_stratum", id_col, salt, cuts, ["in"])
    return out.drop("_stratum", "segment")


def stratified_sample(df: DataFrame, id_col: str, flag: str, n: int, salt: str) -> DataFrame:
    """Sample of ``n`` rows that keeps the share of flagged rows: round(n * ratio) positives, the rest negatives."""
    positives = F.round(F.lit(float(n)) * F.sum(F.when(F.col(flag), 1).otherwise(0)) / F.count("*")).cast("bigint")
    target = df.agg(positives.alias("p")).first()["p"] or 0
    return sample_counts(df, id_col, flag, {True: target, False: n - target}, salt)


def sample_counts(df: DataFrame, id_col: str, flag: str, counts: dict, salt: str) -> DataFrame:
    """The given number of rows of each stratum, in salted-hash order."""
    kind = df.schema[flag].dataType.simpleString()
    cuts = df.sparkSession.createDataFrame(
        [(k, [v]) for k, v in counts.items()], f"`{flag}` {kind}, cuts array<bigint>"
    )
    return hash_segments(df, flag, id_col, salt, cuts, ["in"]).drop("segment")


def three_way_split(
    df: DataFrame, id_col: str, target: str, val: float = 0.2, test: float = 0.2, salt: str = "_split_42"
) -> DataFrame:
    """Adds ``split`` (train/val/test), stratified by target, disjoint, with per-class sizes exact to rounding.

    Both fractions are of the whole. ``val=0`` gives the two-way form.
    """
    n = F.col("n")
    totals = df.groupBy(target).agg(F.count("*").alias("n"))
    cuts = totals.select(
        target,
        F.array(F.round(n * F.lit(test)).cast("bigint"), F.round(n * F.lit(test + val)).cast("bigint")).alias("cuts"),
    )
    out = hash_segments(df, target, id_col, salt, cuts, ["test", "val"], rest="train")
    return out.withColumnRenamed("segment", "split")


def fixture_sample(df: DataFrame, id_col: str, flag: str, counts: dict, salt: str, edge: Column) -> DataFrame:
    """Small deterministic fixture: the counted rows per stratum, plus every edge-case row by UNION ALL."""
    return sample_counts(df.filter(~edge), id_col, flag, counts, salt).unionByName(df.filter(edge))


def _unit(*parts: Column) -> Column:
    """Reproducible number in [0, 1) from the first 32 bits of an md5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def smote_rows(
    df: DataFrame, spec: FeatureSpec, n_new: int, k: int = 5, seed: int = 42, nominal: str = "base"
) -> DataFrame:
    """``n_new`` synthetic rows between minority rows of ``df`` and one of their ``k`` nearest minority neighbours.

    New row j starts from minority row ``floor(j * n / n_new)`` in hash order, so bases are used evenly; neighbour and
    gap come from md5 of (base key, copy, seed). Neighbours' values travel with their base row before new rows are
    exploded, so the synthetic rows are never shuffled. Nominal columns keep the base row's value by default.
    """
    if nominal not in ("base", "interpolate"):
        raise ValueError(f"unknown nominal rule {nominal!r}")
    minority = df.select(spec.id, *[F.col(c).cast("double").alias(c) for c in spec.features])
    n = minority.count()
    if n < 2:
        raise ValueError("oversampling needs at least two minority rows")
    k = min(k, n - 1)
    vectors = minority.select(spec.id, F.array(*spec.features).alias("vec"))
    edges = knn_join(vectors, spec.id, "vec", k)
    other = minority.select(F.col(spec.id).alias("nbr"), F.struct(*spec.features).alias("values"))
    around = (
        edges.join(broadcast_if_small(other), "nbr").groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "values"))).alias("around"))  # k entries per row
    )
    ranked = hash_rank(minority, [], spec.id, f"_smote_{seed}", out="_pos", n_rows=n)
    around = around.withColumnRenamed("id", "_around_id")
    base = ranked.join(around, F.col(spec.id) == F.col("_around_id")).drop("_around_id")
    # Integer bounds of the new rows j with floor(j * n / n_new) = _pos - 1.
    first = F.expr(f"(cast(_pos - 1 as bigint) * {n_new} + {n - 1}) div {n}")
    last = F.expr(f"(cast(_pos as bigint) * {n_new} + {n - 1}) div {n} - 1")
    # A wide explode from few rows: spread the bases first.
    spread = base.repartition(F.col(spec.id)) if n_new > 10 * n else base
    new = spread.filter(last >= first).withColumn("copy", F.explode(F.sequence(first, last)))
    draw = new.withColumns({
        "_pick": (F.floor(_unit(F.col(spec.id), F.col("copy"), F.lit(f"n{seed}")) * k)).cast("int"),
        "_gap": _unit(F.col(spec.id), F.col("copy"), F.lit(f"g{seed}")),
    }).withColumn("_nb", F.col("around")[F.col("_pick")]["values"])
    keep_base = set(spec.nominal) if nominal == "base" else set()
    features = [
        F.col(c) if c in keep_base else (F.col(c) + F.col("_gap") * (F.col(f"_nb.{c}") - F.col(c))).alias(c)
        for c in spec.features
    ]
    return draw.select(F.col(spec.id).alias("base_id"), "copy", *features)


def smote(
    train: DataFrame, spec: FeatureSpec, k: int = 5, seed: int = 42, nominal: str = "base"
) -> DataFrame:
    """Training rows plus synthetic minority rows, both classes equal in size. Never call on validation or test.

    Returns ``row_key`` (text), target (int), features (double) and ``synthetic``.
    """
    counts = {r[0]: r[1] for r in train.groupBy(F.col(spec.target).cast("int").alias("t")).count().collect()}
    if set(counts) != {0, 1}:
        raise ValueError("oversampling needs both classes")
    minority = min(counts, key=lambda c: (counts[c], -c))
    n_new = max(counts.values()) - counts[minority]
    features = [F.col(c).cast("double").alias(c) for c in spec.features]
    key = F.col(spec.id).cast("string")
    originals = train.select(key.alias("row_key"), F.col(spec.target).cast("int").alias(spec.target), *features, F.lit(False).alias("synthetic"))
    if n_new == 0:
        return originals
    rows = smote_rows(train.filter(F.col(spec.target).cast("int") == minority), spec, n_new, k, seed, nominal)
    return originals.unionByName(
        rows.select(F.concat_ws(":", "base_id", "copy").alias("row_key"), F.lit(minority).alias(spec.target), *spec.features, F.lit(True).alias("synthetic"))
    )


def check_splits(split: DataFrame, id_col: str, target: str, parts: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Size and positives per split, plus keys that occur in more than one split (must be zero)."""
    sizes = split.groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.col(target).cast("bigint")).alias("positives")
    )
    shared = split.groupBy(id_col).agg(F.count_distinct("split").alias("s")).agg(
        F.count(F.when(F.col("s") > 1, 1)).alias("shared")
    )
    return sizes.filter(F.col("split").isin(list(parts))).withColumn("shared_keys", shared.scalar())
