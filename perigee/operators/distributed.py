"""Global order statistics without a single-task window: hash ranks, running totals, exact percentiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.session import cut_lineage, small_table

# Rows one window task should sort at most when buckets are filled evenly.
BUCKET_ROWS = 200_000
# Up to this many values an exact percentile may keep its value counts in one aggregation buffer.
PERCENTILE_ROWS = 200_000
# Values between two approximate percentiles that may be sorted in one buffer.
BRACKET_ROWS = 20_000
APPROX_ACCURACY = 10_000
# Ranges of a global order at most, and how many of their bounds are compared one by one.
MAX_RANGES = 4096
GROUP = 64


def hash_key(id_col: str | Column, salt: str) -> Column:
    """Reproducible pseudo-random order: md5 of key and salt, the same text in every engine."""
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(key.cast("string"), F.lit(salt)))


def _prefix_digits(n_rows: int) -> int:
    """Hex digits of the hash that give buckets of about ``BUCKET_ROWS`` rows."""
    return max(1, min(6, math.ceil(math.log(max(n_rows / BUCKET_ROWS, 1.0), 16))))


def _with_hash(df: DataFrame, id_col: str, salt: str, n_rows: int | None) -> DataFrame:
    digits = _prefix_digits(df.count() if n_rows is None else n_rows)
    return df.withColumn("_h", hash_key(id_col, salt)).withColumn("_b", F.substring("_h", 1, digits))


def hash_rank(
    df: DataFrame, by: Sequence[str], id_col: str, salt: str, out: str = "rank", n_rows: int | None = None
) -> DataFrame:
    """Rank 1..n inside each stratum in salted-hash order (ties by key), spread over hash buckets.

    The hash is uniform, so its leading digits split any stratum evenly, however large. Only per-bucket counts are
    summed in order; rows are sorted inside their bucket.
    """
    hashed = _with_hash(df, id_col, salt, n_rows)
    keys = [*by, "_b"]
    running = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = running.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    offsets = small_table(
        hashed.groupBy(*keys).agg(F.count("*").alias("_n"))
        .withColumn("_offset", F.sum("_n").over(running) - F.col("_n"))
        .select(*[F.col(c).alias(f"_k_{c}") for c in keys], "_offset")
    )
    match = F.lit(True)
    for c in keys:
        match = match & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    inside = Window.partitionBy(*keys).orderBy("_h", id_col)
    return (
        hashed.withColumn("_rn", F.row_number().over(inside)).join(offsets, match)
        .withColumn(out, (F.col("_offset") + F.col("_rn")).cast("bigint"))
        .drop("_h", "_b", "_rn", "_offset", *[f"_k_{c}" for c in keys])
    )


def global_rank(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Adds rank 1..n in the order of columns that tell rows apart: ranges are ranked each for itself, and counts of ranges
    before them, one row a range, are added."""
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before, rows = 0, []
    for r in placed.groupBy("_range").count().orderBy("_range").collect():
        rows.append((r["_range"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(rows, "_range int, _before bigint")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn(out, inside).join(F.broadcast(offsets), "_range").withColumn(
        out, F.col(out) + F.col("_before")).drop("_range", "_before")


def hash_segments(
    df: DataFrame, by: str, id_col: str, salt: str, cuts: DataFrame, names: Sequence[str], rest: str | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Adds ``segment`` by where the row's hash rank inside its stratum falls between cumulative cut ranks.

    ``cuts`` has one row per stratum: ``by`` and ``cuts``, an ascending array with one rank per name. Ranks up to
    cuts[0] get names[0], the next ones names[1] and so on; later ranks get ``rest`` or are dropped when it is None.

    The bucket that holds each cut is found from bucket counts. Rows of all other buckets are labelled by comparing
    hash prefixes, without a shuffle; only the boundary buckets are ranked.
    """
    hashed = _with_hash(df, id_col, salt, n_rows)
    running = Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        hashed.groupBy(by, "_b").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    limits = cuts.select(F.col(by).alias("_by"), F.col("cuts").alias("_cuts"))
    steps = range(len(names))
    cut = [F.col("_cuts")[i] for i in steps]
    edges = small_table(
        counts.join(limits, F.col(by).eqNullSafe(F.col("_by"))).groupBy("_by").agg(
            *[
                F.max(F.when(
                    (cut[i] > F.col("_before")) & (cut[i] <= F.col("_upto")),
                    F.struct(F.col("_b").alias("bucket"), (cut[i] - F.col("_before")).alias("take")),
                )).alias(f"_edge{i}")
                for i in steps
            ],
            *[F.min(cut[i] > F.col("_upto")).alias(f"_all{i}") for i in steps],
        )
    )
    placed = hashed.join(edges, F.col(by).eqNullSafe(F.col("_by")))
    on_edge = F.lit(False)
    for i in steps:
        on_edge = on_edge | F.coalesce(F.col("_b") == F.col(f"_edge{i}.bucket"), F.lit(False))

    def label(below) -> Column:
        value = F.lit(rest).cast("string")
        for i in reversed(steps):
            # Without a boundary bucket the cut lies past the stratum (all rows below it) or at zero (none).
            inside = F.when(F.col(f"_edge{i}").isNull(), F.col(f"_all{i}")).otherwise(below(i))
            value = F.when(inside, F.lit(names[i])).otherwise(value)
        return value

    plain = placed.filter(~on_edge).withColumn("segment", label(lambda i: F.col("_b") < F.col(f"_edge{i}.bucket")))
    ranked = placed.filter(on_edge).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(by, "_b").orderBy("_h", id_col))
    )
    edge = ranked.withColumn("segment", label(
        lambda i: (F.col("_b") < F.col(f"_edge{i}.bucket"))
        | ((F.col("_b") == F.col(f"_edge{i}.bucket")) & (F.col("_rn") <= F.col(f"_edge{i}.take")))
    ))
    columns = [*df.columns, "segment"]
    return plain.select(*columns).unionByName(edge.select(*columns)).filter(F.col("segment").isNotNull())


def _bisect(key: Column, bounds: Sequence[float]) -> Column:
    """Number of bounds that are <= key, as a balanced CASE tree."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds))


def _range_of(key: Column, bounds: Sequence[float]) -> Column:
    """Number of bounds <= key: a CASE tree over groups of bounds, then a count inside the group."""
    groups = [list(bounds[i : i + GROUP]) for i in range(0, len(bounds), GROUP)]
    if len(groups) <= 1:
        return _bisect(key, bounds)
    group = _bisect(key, [g[0] for g in groups[1:]])
    inside = F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group + 1)
    return group * GROUP + F.size(F.filter(inside, lambda b: b <= key))


def running_totals(
    df: DataFrame, key: str, sums: Sequence[str], descending: bool = True, range_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Running sums of ``sums`` over the whole order of a numeric ``key`` that is unique in ``df``.

    Adds ``cum_<col>`` and ``total_<col>``. A null key comes last in either direction. Keys are split by approximate
    quantiles into ranges of about ``range_rows`` rows, as many as the data needs (MAX_RANGES at most; beyond that,
    ranges grow); one row of totals per range gives the offsets, which are joined; rows are summed inside their range.
    The range of a row depends only on its key, so recomputed partitions give the same result.
    """
    n = df.agg(F.count(key)).first()[0]
    ranges = min(max(1, -(-n // range_rows)), MAX_RANGES)
    probes = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(df.agg(F.percentile_approx(key, probes, APPROX_ACCURACY)).first()[0] or [])) if probes else []
    last = -1 if descending else len(bounds) + 1
    ranged = df.withColumn("_range", F.when(F.col(key).isNull(), last).otherwise(_range_of(F.col(key), bounds)))
    per_range = ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sums]).collect()  # at most MAX_RANGES + 1 rows
    before, acc = [], dict.fromkeys(sums, 0)
    for row in sorted(per_range, key=lambda r: r["_range"], reverse=descending):
        before.append((row["_range"], *[acc[c] for c in sums]))
        acc = {c: acc[c] + (row[c] or 0) for c in sums}
    types = {f.name: f.dataType for f in ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sums]).schema.fields}
    offsets = df.sparkSession.createDataFrame(
        before, T.StructType([T.StructField("_range", T.IntegerType())] + [T.StructField(f"_offset_{c}", types[c]) for c in sums])
    )
    order = F.col(key).desc() if descending else F.col(key).asc()
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in sums}).join(F.broadcast(offsets), "_range")
    out = out.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_offset_{c}") for c in sums})
    return out.withColumns({f"total_{c}": F.lit(acc[c]) for c in sums}).drop("_range", *[f"_offset_{c}" for c in sums])


def exact_percentiles(
    df: DataFrame, cols: Sequence[str], qs: Sequence[float], small: int = PERCENTILE_ROWS, inside: int = BRACKET_ROWS
) -> dict[str, list[float | None]]:
    """Linear-interpolated percentiles of several columns, exact at any size.

    Few values go through the built-in aggregate. Beyond ``small`` values its buffer would have to hold every distinct
    value in one task. Then each wanted rank is bracketed by two approximate percentiles, one pass counts what lies
    below, on and between the brackets, and only values strictly between them are looked at, when the rank falls there.
    All columns and percentiles share these passes. A bracket that holds more than ``inside`` values is refined alone.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict()
    out: dict[str, list[float | None]] = {c: [None] * len(qs) for c in cols}
    direct = [c for c in cols if 0 < counts[c] <= small]
    if direct:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, qs))).alias(c) for c in direct]).first()
        out.update({c: list(row[c]) for c in direct})
    large = [c for c in cols if counts[c] > small]
    if not large:
        return out
    ranks = {(c, j): (math.floor(q * (counts[c] - 1)), math.ceil(q * (counts[c] - 1))) for c in large for j, q in enumerate(qs)}
    x = {c: F.col(c).cast("double") for c in large}
    probes = {
        c: [p for j in range(len(qs)) for p in _around(*ranks[c, j], counts[c])] for c in large
    }
    found = df.agg(*[F.percentile_approx(x[c], probes[c], APPROX_ACCURACY).alias(c) for c in large]).first()
    bracket = {(c, j): (found[c][2 * j], found[c][2 * j + 1]) for c, j in ranks}

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    tally = df.agg(*[
        F.struct(
            count(x[c] < lo).alias("below"), count(x[c] == lo).alias("low"),
            count((x[c] > lo) & (x[c] < hi)).alias("mid"), count(x[c] == hi).alias("high"),
        ).alias(f"{c}~{j}")
        for (c, j), (lo, hi) in bracket.items()
    ]).first()
    value: dict[tuple, dict[int, float]] = {}
    listed, alone = {}, []
    for (c, j), (lo, hi) in bracket.items():
        t = tally[f"{c}~{j}"]
        start = t["below"] + t["low"]  # first rank strictly inside
        stop = start + t["mid"]
        if ranks[c, j][0] < t["below"] or ranks[c, j][1] >= stop + (t["high"] if hi > lo else 0):
            alone.append((c, j))
            continue
        value[c, j] = {r: lo if r < start else hi for r in ranks[c, j] if not start <= r < stop}
        open_ranks = [r for r in ranks[c, j] if start <= r < stop]
        if open_ranks and t["mid"] > inside:
            alone.append((c, j))
        elif open_ranks:
            listed[c, j] = (start, open_ranks)
    if listed:
        row = df.agg(*[
            F.array_sort(F.collect_list(F.when((x[c] > bracket[c, j][0]) & (x[c] < bracket[c, j][1]), x[c]))).alias(f"{c}~{j}")
            for c, j in listed
        ]).first()  # at most `inside` values each
        for (c, j), (start, open_ranks) in listed.items():
            value[c, j].update({r: row[f"{c}~{j}"][r - start] for r in open_ranks})
    for c, j in alone:
        values = df.select(x[c].alias("x")).filter(F.col("x").isNotNull())
        value[c, j] = dict(zip(ranks[c, j], _order_statistics(values, counts[c], list(ranks[c, j]), inside)))
    for (c, j), (lower, upper) in ranks.items():
        v = value[c, j]
        out[c][j] = v[lower] + (v[upper] - v[lower]) * (qs[j] * (counts[c] - 1) - lower)
    return out


def _around(lower: int, upper: int, n: int) -> list[float]:
    """Probabilities on either side of two ranks, wider than the error of an approximate percentile."""
    return [max(0.0, lower / n - 2 / APPROX_ACCURACY), min(1.0, (upper + 1) / n + 2 / APPROX_ACCURACY)]


def _order_statistics(values: DataFrame, n: int, ranks: list[int], small: int) -> list[float]:
    """Values at two neighbouring zero-based ranks of column ``x``."""
    while n > small:
        lo, hi = values.agg(F.percentile_approx("x", _around(*ranks, n), APPROX_ACCURACY).alias("b")).first()["b"]
        tally = values.agg(
            F.count(F.when(F.col("x") < lo, 1)).alias("below"),
            F.count(F.when((F.col("x") >= lo) & (F.col("x") <= hi), 1)).alias("inside"),
        ).first()
        held = tally["below"] <= ranks[0] and ranks[1] < tally["below"] + tally["inside"]
        if not held or tally["inside"] == n and lo != hi:
            break  # the bracket missed its rank, or many copies keep it from shrinking
        if lo == hi:
            return [lo, lo]
        values = values.filter((F.col("x") >= lo) & (F.col("x") <= hi))
        ranks = [r - tally["below"] for r in ranks]
        n = tally["inside"]
    # Count the copies of each value and walk the running count over its range-partitioned order.
    running = running_totals(values.groupBy("x").agg(F.count("*").alias("c")), "x", ["c"], descending=False)
    row = running.agg(*[F.min(F.when(F.col("cum_c") > r, F.col("x"))).alias(f"v{i}") for i, r in enumerate(ranks)]).first()
    return [row["v0"], row["v1"]]
