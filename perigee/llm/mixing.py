"""Mixing sources to target token counts by entropy balancing.

Among all document rates that give every group its target, the one closest to the base rates in relative entropy, with
no rate above ``max_copies``, is ``min(max_copies, base * exp(group's multiplier))``. The multipliers solve a convex
dual; Newton steps find them from sums over documents. Rates are then rounded to whole copies: every document takes the
whole part, and a cut in a fixed pseudo-random order decides which take one more, so each group's words meet its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.llm.common import WORD, store, table

NEWTON_STEPS = 60
LARGEST = 40.0
TOLERANCE = 1e-9
# A rate this close to a whole number is that number.
SNAP = 1e-7
# Keys are hashes of 40 bits divided by the rate's fraction; words are summed by their bits above these.
FIRST_BITS, SECOND_BITS = 28, 16
# Tables of a row per source are kept as local relations up to this many rows, and stored beyond.
SMALL = 10_000


def settle(df: DataFrame) -> DataFrame:
    """The frame with its plan cut, without a file where it has few rows: one step of many is not worth a job's folders and files."""
    rows = df.limit(SMALL + 1).toArrow()
    return store(df) if len(rows) > SMALL else df.sparkSession.createDataFrame(rows, df.schema)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_filled_targets(sizes: DataFrame, share: float, weights: tuple[float, ...], max_repeat: float) -> DataFrame:
    """``(source, source_size, target)`` from one row per source with its ``source_size``.

    Sources in code point order, null last, take the weights in turn. They share ``share`` times all sizes by weight,
    none above ``max_repeat`` times its own; what would be above is shared again. Sorted by the level at which they
    fill up, sources before some point are full and the rest stand at one level, which running sums give at once.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight.cast("double"))
    ranked = ranked.withColumn("cap", max_repeat * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    levels = ranked.select(
        "*", F.sum("cap").over(filling).alias("full"), F.sum("weight").over(filling).alias("used"),
        F.sum("weight").over(everything).alias("all_weight"), (share * F.sum("source_size").over(everything)).alias("budget"),
    )
    # The level if exactly the sources before this one are full; the first that stays below it is not full.
    level = (F.col("budget") - (F.col("full") - F.col("cap"))) / (F.col("all_weight") - (F.col("used") - F.col("weight")))
    levels = levels.withColumn("level", F.when(level <= F.col("cap") / F.col("weight"), level))
    lowest = F.first("level", ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("level", lowest).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), "cap")).alias("target")
    )


def balanced_rates(groups: DataFrame, max_copies: float) -> DataFrame:
    """``(g, target, multiplier)`` from ``(g, base, size, target)``, where size sums a group's documents of one base rate.

    Safeguarded Newton on the dual, for all groups at once. Its derivative by a group's multiplier is the words that the rates give, less the target;
    the second derivative is the words of documents below the limit.
    """
    groups = settle(groups)
    # The multipliers if no rate met the limit; Newton steps mend them where some do.
    plain = F.sum(F.col("base") * F.col("size"))
    start = F.when((plain > 0) & (F.col("target") > 0), F.ln(F.col("target") / plain)).otherwise(0.0)
    state = groups.groupBy("g", "target").agg(start.alias("multiplier"))
    state = state.withColumn("low", F.lit(-LARGEST)).withColumn("high", F.lit(LARGEST))
    for _ in range(NEWTON_STEPS):
        rate = F.col("base") * F.exp("multiplier")
        words = F.col("size") * F.least(rate, F.lit(float(max_copies)))
        sums = groups.drop("target").join(state, "g").groupBy("g", "target", "multiplier", "low", "high").agg(
            F.sum(words).alias("got"), F.sum(F.when(rate < max_copies, words).otherwise(0.0)).alias("slope")
        )
        gap = F.col("target") - F.col("got")
        sums = sums.withColumn("done", (F.abs(gap) <= TOLERANCE * F.greatest("target", F.lit(1.0))) | (F.col("high") - F.col("low") < 1e-12))
        sums = sums.withColumn("low", F.when(gap > 0, F.col("multiplier")).otherwise(F.col("low")))
        sums = sums.withColumn("high", F.when(gap < 0, F.col("multiplier")).otherwise(F.col("high")))
        newton = F.col("multiplier") + gap / F.when(F.col("slope") > 0, F.col("slope"))
        # A step out of the interval known to hold the solution is replaced by halving the interval.
        step = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise((F.col("low") + F.col("high")) / 2)
        stepped = settle(sums.select("g", "target", F.when(F.col("done"), F.col("multiplier")).otherwise(step).alias("multiplier"), "low", "high", "done"))
        state = stepped.drop("done")
        if not stepped.filter("not done").limit(1).count():
            break
    return state.drop("low", "high")


def prefix_cuts(free: DataFrame, need: DataFrame) -> DataFrame:
    """``(g, cut)`` for each group of ``need`` (g, need): the documents of ``free`` (g, size, key) with keys up to the cut
    have at most the needed words, and those with the next key would have more.

    Words are summed by the leading bits of the key, then by the next bits in the part where the sum passes the need,
    then in order inside that small part.
    """
    # Below `low` (a bin of the current width) all keys are taken, which gives `taken` words.
    state = need.withColumn("low", F.lit(None).cast("long")).withColumn("taken", F.lit(0.0))
    for bits in (FIRST_BITS, SECOND_BITS):
        inside = free.join(state, "g").withColumn("bin", F.shiftright("key", bits))
        if bits != FIRST_BITS:
            inside = inside.filter(F.shiftright("key", FIRST_BITS) == F.col("low"))
        sums = inside.groupBy("g", "need", "taken", "bin").agg(F.sum("size").alias("s"))
        running = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        passed = sums.withColumn("after", F.col("taken") + F.sum("s").over(running)).filter("after > need")
        first = passed.groupBy("g").agg(F.min_by(F.struct(F.col("bin").alias("low"), (F.col("after") - F.col("s")).alias("taken")), "bin").alias("x"))
        state = settle(need.join(first.select("g", "x.low", "x.taken"), "g", "left"))
    inside = free.join(state, "g").filter(F.shiftright("key", SECOND_BITS) == F.col("low"))
    # The default frame of an ordered window includes peers: equal keys are taken together or not at all.
    after = F.col("taken") + F.sum("size").over(Window.partitionBy("g").orderBy("key"))
    last = inside.withColumn("after", after).filter("after <= need").groupBy("g").agg(F.max("key").alias("key"))
    # A group that never passes its need takes every document.
    cut = F.coalesce("key", F.shiftleft("low", SECOND_BITS) - 1, F.lit((1 << 62)))
    return settle(state.join(last, "g", "left").select("g", cut.alias("cut")))


def rounding_cuts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(g, cut)`` and ``(g, key)`` of fills: a document takes one copy more if its key is at most the cut or among the fills.

    ``rows`` is (g, size, whole, key, target). Keys order a group's documents pseudo-randomly and equal rows share one.
    The first cut stops where the next document is too large for what the whole parts leave of the target. What is
    still needed goes to documents behind it that are small enough, cut in the same order, until none fits. Fills
    together have fewer words than the document at the first cut.
    """
    need = settle(rows.groupBy("g").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need")))
    free = rows.filter("key is not null and size > 0").select("g", "size", "key")
    cuts = prefix_cuts(free, need)
    placed = free.join(cuts, "g")
    got = placed.filter("key <= cut").groupBy("g").agg(F.sum("size").alias("got"))
    need = settle(need.join(got, "g", "left").select("g", (F.col("need") - F.coalesce("got", F.lit(0))).alias("need")))
    behind = placed.filter("key > cut").groupBy("g", "key").agg(F.sum("size").alias("size"))
    fills = None
    while True:
        # What does not fit now never will, as the need only falls.
        behind = store(behind.join(need, "g").filter("size <= need").select("g", "size", "key"))
        if not behind.limit(1).count():
            break
        # Groups where nothing fits are left out.
        placed = behind.join(prefix_cuts(behind, need.join(behind.select("g").distinct(), "g", "left_semi")), "g")
        add = store(placed.filter("key <= cut").select("g", "size", "key"))
        fills = add if fills is None else fills.unionByName(add)
        got = add.groupBy("g").agg(F.sum("size").alias("got"))
        need = settle(need.join(got, "g").select("g", (F.col("need") - F.col("got")).alias("need")))
        behind = placed.filter("key > cut").select("g", "size", "key")
    return cuts, behind.select("g", "key") if fills is None else store(fills.select("g", "key"))


def mix(
    docs: DataFrame, keep: list[str], share: float = 1.5, weights: tuple[float, ...] = (5.0, 2.0, 1.0), max_copies: float = 2.0,
    source: str = "source", text: str = "text", id_col: str = "doc_id", base: Column | None = None,
) -> DataFrame:
    """``keep`` with size, source_size, target and copies of every document of the mix.

    ``base`` are rates to stay close to (1 by default, nulls and negative ones count as 0). A null source is a source of
    its own and a null text has no words. Repeated rows get equal copies. Documents without words take the whole part
    of their rate. The tables by source and of fills are joined by Spark's choice: sent to all tasks if small, else
    shuffled with hot sources split.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))
    rate = F.lit(1.0) if base is None else F.greatest(F.coalesce(base, F.lit(0.0)), F.lit(0.0))
    sized = docs.select(
        *[F.col(c) for c in keep], F.col(source).alias("_source"), group.alias("_g"), word_count(F.col(text)).alias("_size"), rate.alias("_base"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("rounding")), 24).alias("_u"),
    )
    slim = store(sized.select("_source", "_g", "_size", "_base", "_u"))
    by_source = slim.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    sources = settle(water_filled_targets(by_source, share, weights, max_copies).withColumn("g", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))))
    by_base = slim.groupBy(F.col("_g").alias("g"), F.col("_base").alias("base")).agg(F.sum("_size").cast("double").alias("size"))
    state = balanced_rates(by_base.join(sources.select("g", "target"), "g"), max_copies)
    plan = sources.select("g", "source_size", "target").join(state.select("g", "multiplier"), "g")

    def rounded(df: DataFrame) -> DataFrame:
        df = df.join(plan.withColumnRenamed("g", "_g"), "_g")
        exact = F.least(F.col("_base") * F.exp("multiplier"), F.lit(float(max_copies)))
        exact = F.when(F.abs(exact - F.round(exact)) < SNAP, F.round(exact)).otherwise(exact)
        fraction = F.col("_rate") - F.col("_whole")
        return (
            df.withColumn("_rate", exact).withColumn("_whole", F.floor("_rate").cast("long"))
            .withColumn("_key", F.when(fraction > 0, F.least(F.col("_u") / fraction, F.lit(float(1 << 44))).cast("long")))
        )

    plan = settle(plan)
    cuts, fills = rounding_cuts(store(rounded(slim).select(
        F.col("_g").alias("g"), F.col("_size").alias("size"), F.col("_whole").alias("whole"), F.col("_key").alias("key"), "target"
    )))
    plan = settle(plan.join(cuts, "g", "left"))
    fills = fills.select(F.col("g").alias("_g"), F.col("key").alias("_key"), F.lit(True).alias("_fill"))
    extra = F.coalesce(F.col("_key") <= F.col("cut"), F.lit(False)) | F.coalesce("_fill", F.lit(False))
    extra = F.when(F.col("_size") > 0, extra.cast("long")).otherwise(0)
    return rounded(sized).join(fills, ["_g", "_key"], "left").select(
        *keep, F.col("_size").alias("size"), "source_size", "target", (F.col("_whole") + extra).alias("copies"),
    )


def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


QUERIES = {"op1_entropy_mix": op1_entropy_mix}
