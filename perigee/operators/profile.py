"""Population profiles: counts, missing values, summaries, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.distributed import exact_percentiles
from perigee.session import small_table


def _unpivot(row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """One-row frame with a struct per name to one row per name."""
    entries = F.array(*[F.struct(F.lit(n).alias(key), *[F.col(f"`{n}`.{f}").alias(f) for f in fields]) for n in names])
    return row.select(F.inline(entries))


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage (two decimals) of every column that has any, most missing first. One scan."""
    cols = list(cols or df.columns)
    row = df.agg(*[
        F.struct(
            F.count(F.when(F.col(c).isNull(), 1)).alias("missing_count"),
            F.round(F.count(F.when(F.col(c).isNull(), 1)) * F.lit(100.0) / F.count("*"), 2).alias("missing_pct"),
        ).alias(c)
        for c in cols
    ])
    out = _unpivot(row, cols, ["missing_count", "missing_pct"])
    return out.filter("missing_count > 0").orderBy(F.desc("missing_count"), "column")


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """Count, percentage and ratio of the largest class to each class."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("all"), F.max("n").alias("top"))).scalar()
    return counts.select(
        col, "n",
        (F.col("n") * F.lit(100.0) / total.getField("all")).alias("pct"),
        (total.getField("top") / F.col("n")).alias("ratio"),
    )


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles and maximum per column."""
    base = df.agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c)
        for c in cols
    ])
    out = _unpivot(base, cols, ["count", "mean", "std", "min", "max"])
    return _with_percentiles(out, df, cols, {"p25": 0.25, "p50": 0.5, "p75": 0.75})


def extreme_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, median, p95, p99 and maximum per column."""
    base = df.agg(*[
        F.struct(F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max")).alias(c)
        for c in cols
    ])
    out = _unpivot(base, cols, ["min", "max"])
    return _with_percentiles(out, df, cols, {"median": 0.5, "p95": 0.95, "p99": 0.99})


def _with_percentiles(out: DataFrame, df: DataFrame, cols: Sequence[str], wanted: dict[str, float]) -> DataFrame:
    found = exact_percentiles(df, cols, list(wanted.values()))
    for j, name in enumerate(wanted):
        value = F.lit(None).cast("double")
        for c in cols:
            value = F.when(F.col("column") == c, F.lit(found[c][j])).otherwise(value)
        out = out.withColumn(name, value)
    return out


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None, density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed on both sides; with ``by``, each class has its own range.

    Empty bins are absent. Ranges come from one aggregate; with ``by`` they are joined back per class.
    """
    x = F.col(col).cast("double")
    keys = [by] if by else []
    values = df.select(*keys, x.alias("x")).filter(F.col("x").isNotNull())
    limits = [F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")]
    if by:
        ranges = small_table(values.groupBy(by).agg(F.struct(*limits).alias("r")).withColumnRenamed(by, "_class"))
        ranged = values.join(ranges, F.col(by).eqNullSafe(F.col("_class")))
    else:
        ranged = values.withColumn("r", values.agg(F.struct(*limits)).scalar())
    width = (F.col("r.hi") - F.col("r.lo")) / bins
    # A single-valued column gets unit width around its value, so that it falls into the middle bin.
    width = F.when(width == 0, F.lit(1.0) / bins).otherwise(width)
    lo = F.when(F.col("r.hi") == F.col("r.lo"), F.col("r.lo") - 0.5).otherwise(F.col("r.lo"))
    placed = ranged.withColumns({"lo": lo, "width": width}).withColumn(
        "bin", F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    )
    out = placed.groupBy(*keys, "bin").agg(
        F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("width").alias("width"), F.first("r.n").alias("total")
    )
    columns: list[str | Column] = [
        *keys, "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"), "n",
    ]
    if density:
        columns.append((F.col("n") / (F.col("total") * F.col("width"))).alias("density"))
    return out.select(*columns)


def _corr(x: str, y: str) -> Column:
    return F.corr(F.col(x).cast("double"), F.col(y).cast("double"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair; constant columns give null. One aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[_corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    entries = []
    for a, b in pairs:
        value = F.col(f"`{a}~{b}`")
        entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), value.alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), value.alias("corr")))
    out = row.select(F.inline(F.array(*entries)))
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


def target_correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    row = df.agg(*[F.struct(_corr(c, target).alias("corr")).alias(c) for c in cols])
    out = _unpivot(row, cols, ["corr"]).withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))
    return out.orderBy(F.abs("corr").desc_nulls_last(), "column")


def group_summary(
    df: DataFrame, by: Sequence[str], averages: Sequence[str], flag: str | Column | None = None, flag_name: str = "n_flag"
) -> DataFrame:
    """Count, averages and number of flagged rows per group, ordered by group."""
    aggs = [F.count("*").alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in averages]]
    if flag is not None:
        condition = F.col(flag) if isinstance(flag, str) else flag
        aggs.append(F.sum(F.when(condition, 1).otherwise(0)).alias(flag_name))
    return df.groupBy(*by).agg(*aggs).orderBy(*by)


def scaled_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and standard deviation per column, to confirm a scaler."""
    row = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in cols])
    return _unpivot(row, cols, ["mean", "std"])
