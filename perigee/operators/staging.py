"""Cleaning, encoding, percentile caps and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.operators.distributed import exact_percentiles
from perigee.session import broadcast_if_small


def keep_known(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose columns are neither null nor blank text."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return df


def encode_flag(df: DataFrame, col: str, yes: str, out: str) -> DataFrame:
    """Boolean flag. Run after :func:`keep_known`, so that an unknown value is dropped instead of read as "no"."""
    return df.withColumn(out, F.col(col) == F.lit(yes))


def drop_any_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drops rows with a null in any listed column; NaN counts as a value, as in SQL."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    return df.filter(keep)


def encode_by_seed(df: DataFrame, col: str, seed: DataFrame, key: str, code: str) -> DataFrame:
    """Left join to a code seed; values the seed lacks get a null code."""
    lookup = seed.select(F.col(key).alias("_seed_key"), F.col(code))
    return df.join(broadcast_if_small(lookup), F.col(col) == F.col("_seed_key"), "left").drop("_seed_key")


def derive_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Alphabetical codes of the distinct values. Only for writing a seed once: codes shift when values change.

    The distinct values are reduced first and must be few, as class labels are.
    """
    distinct = df.select(col).filter(F.col(col).isNotNull()).distinct()
    values = distinct.agg(F.array_sort(F.collect_list(col))).scalar()
    return distinct.select(col, (F.array_position(values, F.col(col)) - 1).cast("int").alias(code))


def feature_caps(df: DataFrame, cols: Sequence[str], q: float = 0.99, mode: str = "exact") -> DataFrame:
    """One row with ``<col>_p99`` for every column."""
    suffix = f"p{round(q * 100):02d}"
    if mode == "approx":
        return df.agg(*[F.percentile_approx(c, q, 10_000).cast("double").alias(f"{c}_{suffix}") for c in cols])
    if mode != "exact":
        raise ValueError(f"unknown percentile mode {mode!r}")
    found = exact_percentiles(df, cols, [q])
    schema = ", ".join(f"`{c}_{suffix}` double" for c in cols)
    return df.sparkSession.createDataFrame([tuple(found[c][0] for c in cols)], schema)


def cap_upper(df: DataFrame, caps: DataFrame, cols: Sequence[str], suffix: str = "p99") -> DataFrame:
    """``least(x, cap)`` with the one-row caps table read as a scalar subquery; a null cap leaves values as they are."""
    cap = caps.select(F.struct(*[f"{c}_{suffix}" for c in cols]).alias("caps")).scalar()
    return df.withColumns({c: F.least(F.col(c), cap.getField(f"{c}_{suffix}")) for c in cols})


def clip_quantiles(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Two-sided clip at exact quantiles. Nulls stay null."""
    found = exact_percentiles(df, cols, [lo, hi])
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(found[c][0])), F.lit(found[c][1])))
        for c in cols
    })


def names_dim(raw: DataFrame, fact: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Lookup dimension restricted to keys of the fact, so that no name dangles. Semi join: rows cannot multiply."""
    return raw.select(key, *cols).join(fact.select(key), key, "left_semi")


def orbital_features(df: DataFrame, a: str = "a", e: str = "e", i: str = "i", moid: str = "moid") -> DataFrame:
    """Tisserand parameter, orbital energy and MOID/eccentricity ratio. An open orbit (e > 1) has no Tisserand value."""
    a_jupiter = F.lit(5.203)
    shape = (F.col(a) / a_jupiter) * (1 - F.col(e) * F.col(e))
    return df.withColumns({
        "tisserand_J": F.when(
            shape >= 0, a_jupiter / F.col(a) + 2 * F.sqrt(shape) * F.cos(F.radians(F.col(i)))
        ),
        "orbital_energy": -1.0 / F.col(a),
        "moid_ecc_ratio": F.col(moid) / (F.col(e) + F.lit(1e-9)),
    })


def stage_bodies(raw: DataFrame, seed: DataFrame, elements: Sequence[str], keep: Sequence[str] = ("spkid",)) -> DataFrame:
    """Raw catalogue to staged population: known flags, boolean encoding, class codes, complete rows."""
    known = keep_known(raw, ["pha", "neo"])
    flagged = encode_flag(encode_flag(known, "pha", "Y", "is_pha"), "neo", "Y", "is_neo")
    coded = encode_by_seed(
        flagged.select(*keep, "is_pha", "is_neo", "class", *elements), "class", seed, "class_abbr", "class_code"
    )
    return drop_any_null(coded, [*elements, "class_code"])
