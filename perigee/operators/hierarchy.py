"""Single linkage over a spanning forest: its merges as a table, the condensed tree and its most stable clusters.

Adding the edges of a forest from the lightest to the heaviest merges two components at each edge. ``merge_tree`` gives
these merges for forests of any size: an edge only needs to know the components that all lighter edges make. Edges are
cut into blocks by rank. Level by level, halves of blocks are told apart: the lighter half makes components, all halves of
a level at once, and the heavier half sees each of them as one vertex. Blocks that are small enough are merged one by one
in a task. So there are as many levels as the logarithm of the number of blocks.

``condense`` keeps what is at least ``min_size`` rows large. A cluster lives while merges take fewer rows than that from it,
seen from the heaviest edge downwards, and ends where it splits into two that are both large enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.distributed import global_rank
from perigee.operators.graph import components
from perigee.session import cut_lineage

# Edges that one task merges one by one.
BLOCK = 1 << 16
LINKAGE = "rank bigint, w double, small bigint, large bigint, parent bigint, label bigint, first boolean"


def _merge_block(block: pa.Table) -> pa.Table:
    """Merges of one block in the order of rank; a second kind of rows, ``first``, tells every vertex the merge it meets first."""
    order = np.argsort(block.column("rank").to_numpy())
    rank, w, a, na, b, nb = (block.column(c).to_numpy()[order] for c in ("rank", "w", "a", "na", "b", "nb"))
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    size = np.zeros(len(names), np.int64)
    size[ends] = np.concatenate([na, nb])
    own_size, label = size.copy(), names.copy()
    up, node = np.arange(len(names)), np.full(len(names), -1)

    def find(v: int) -> int:
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    n = len(rank)
    small, large, parent, named = (np.zeros(n, np.int64) for _ in range(4))
    parent[:] = -1
    first = np.full(len(names), -1)
    for i, (x, y) in enumerate(zip(ends[:n], ends[n:])):
        for v in (x, y):
            if first[v] < 0:
                first[v] = rank[i]
        x, y = find(x), find(y)
        if size[x] > size[y]:
            x, y = y, x
        small[i], large[i] = size[x], size[y]
        for v in (x, y):
            if node[v] >= 0:
                parent[node[v]] = rank[i]
        up[x] = y
        size[y] += size[x]
        label[y] = min(label[x], label[y])
        node[y], named[i] = i, label[y]
    merges = [pa.array(rank), pa.array(w), pa.array(small), pa.array(large), pa.array(parent, mask=parent < 0), pa.array(named), pa.array(np.zeros(n, bool))]
    m = len(names)
    firsts = [pa.array(first), pa.nulls(m, pa.float64()), pa.array(own_size), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(names), pa.array(np.ones(m, bool))]
    columns = ["rank", "w", "small", "large", "parent", "label", "first"]
    return pa.concat_tables([pa.table(dict(zip(columns, part))) for part in (merges, firsts)])


def merge_tree(forest: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Merges ``(rank, w, small, large, parent, label)`` of a forest ``(src, dst, w)``, and ``(v, rank)``, the first merge of each vertex.

    Edges are ranked by (w, src, dst). ``small`` and ``large`` are the sizes of the two sides, ``label`` is the smallest
    vertex of both, ``parent`` the rank of the next merge of what came out, null for the last one of a tree.
    """
    ranked = global_rank(forest.select("src", "dst", "w"), ["w", "src", "dst"], "rank")
    one = F.lit(1).cast("long")
    edges = cut_lineage(ranked.select(
        (F.col("rank") - 1).alias("rank"), "w", F.col("src").alias("a"), one.alias("na"), F.col("dst").alias("b"), one.alias("nb")
    ))
    span = block
    total = edges.count()
    while span < total:
        span *= 2
    while span > block:
        sub, light = F.floor(F.col("rank") / span), F.col("rank") % span < span // 2
        placed = edges.withColumn("sub", sub)
        lower = placed.filter(light)
        labels = components(lower.select("sub", F.col("a").alias("src"), F.col("b").alias("dst")), ["sub"])
        vertices = lower.select("sub", F.col("a").alias("v"), F.col("na").alias("n")).unionByName(
            lower.select("sub", F.col("b").alias("v"), F.col("nb").alias("n"))).distinct()
        sizes = labels.join(vertices, ["sub", "v"]).groupBy("sub", "c").agg(F.sum("n").alias("n"))
        named = cut_lineage(labels.join(sizes, ["sub", "c"]))
        upper = placed.filter(~light)
        for end in ("a", "b"):
            seen = named.select("sub", F.col("v").alias(end), F.col("c").alias("_c"), F.col("n").alias("_n"))
            upper = upper.join(seen, ["sub", end], "left").withColumns(
                {end: F.coalesce("_c", end), f"n{end}": F.coalesce("_n", f"n{end}")}).drop("_c", "_n")
        edges = cut_lineage(lower.select(*edges.columns).unionByName(upper.select(*edges.columns)))
        span //= 2
    rows = edges.withColumn("_block", F.floor(F.col("rank") / block)).groupBy("_block").applyInArrow(_merge_block, LINKAGE)
    rows = cut_lineage(rows)
    # The last merge of a block's component goes on where a heavier block has that component, of that size, as a vertex.
    firsts = rows.filter("first").select("label", F.col("small").alias("size"), F.col("rank").alias("next"))
    merges = rows.filter("not first").withColumn("size", F.col("small") + F.col("large"))
    linked = merges.join(firsts.filter("size > 1"), ["label", "size"], "left")
    merges = cut_lineage(linked.select("rank", "w", "small", "large", F.coalesce("parent", F.when(F.col("next") > F.col("rank"), F.col("next"))).alias("parent"), "label"))
    return merges, firsts.filter("size = 1").select(F.col("label").alias("v"), F.col("next").alias("rank"))


def climb(steps: DataFrame) -> DataFrame:
    """``(x, up)`` with every ``up`` followed until it is no ``x`` or points to itself; each round doubles the steps, so rounds are logarithmic."""
    while True:
        ahead = steps.select(F.col("x").alias("up"), F.col("up").alias("next"))
        moved = cut_lineage(steps.join(ahead, "up", "left").select(
            "x", F.coalesce("next", "up").alias("up"), F.coalesce(F.col("next") != F.col("up"), F.lit(False)).alias("moved")
        ))
        steps = moved.select("x", "up")
        if moved.filter("moved").isEmpty():
            return steps


def best_values(clusters: DataFrame) -> DataFrame:
    """``(c, value)`` of a tree ``(c, pc, own)``: the larger of a node's own value and the sum over its children.

    A node whose children are all known is settled. One with a single unknown child is a function max(a, x + k) of that
    child's value, and along chains these functions are composed by doubling. So rounds are logarithmic however deep the
    tree is.
    """
    unknown = [F.lit(None).cast(kind).alias(name) for name, kind in (("value", "double"), ("ptr", "bigint"), ("k", "double"), ("a", "double"))]
    state = cut_lineage(clusters.select("c", "pc", "own", *unknown))
    while not state.filter("value is null").isEmpty():
        below = state.filter("pc is not null").groupBy(F.col("pc").alias("c")).agg(
            F.count("*").alias("children"), F.count("value").alias("known"), F.sum("value").alias("total"),
            F.max(F.when(F.col("value").isNull(), F.col("c"))).alias("open"),
        )
        seen = state.join(below, "c", "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
        settled = F.coalesce(F.col("children") == F.col("known"), F.lit(True))
        chain = F.col("ptr").isNull() & F.coalesce(F.col("children") - F.col("known") == 1, F.lit(False))
        now = cut_lineage(seen.select(
            "c", "pc", "own", F.coalesce("value", F.when(settled, F.greatest("own", "total"))).alias("value"),
            *[F.when(chain, F.col(new)).otherwise(F.col(old)).alias(old) for new, old in (("open", "ptr"), ("total", "k"), ("own", "a"))],
        ))
        ahead = now.select(F.col("c").alias("ptr"), *[F.col(c).alias(f"{c}2") for c in ("value", "ptr", "k", "a")])
        known, further = F.col("value2").isNotNull(), F.col("value2").isNull() & F.col("ptr2").isNotNull()
        state = cut_lineage(now.join(ahead, "ptr", "left").select(
            "c", "pc", "own", F.coalesce("value", F.when(known, F.greatest(F.col("a"), F.col("value2") + F.col("k")))).alias("value"),
            F.when(further, F.col("ptr2")).otherwise(F.col("ptr")).alias("ptr"),
            F.when(further, F.col("k") + F.col("k2")).otherwise(F.col("k")).alias("k"),
            F.when(further, F.greatest(F.col("a"), F.col("a2") + F.col("k"))).otherwise(F.col("a")).alias("a"),
        ))
    return state.select("c", "value")


def condense(merges: DataFrame, min_size: int) -> tuple[DataFrame, DataFrame]:
    """The condensed tree ``(c, pc, label, size, birth, own)`` and ``(rank, c)``, the cluster that every large merge belongs to.

    A merge is large when at least ``min_size`` rows come out of it, and splits when both sides are large. A cluster is named
    by its heaviest merge; ``pc`` is the cluster it split from, ``birth`` the density of that split (0 without one), density
    being 1 / w. ``own`` is its stability: for every row the density at which it leaves less the one at birth, summed. A
    weight of zero counts as the smallest positive one.
    """
    least = merges.agg(F.min(F.when(F.col("w") > 0, F.col("w")))).first()[0] or 1.0
    large = merges.filter(F.col("small") + F.col("large") >= min_size).withColumns({
        "density": F.lit(1.0) / F.greatest("w", F.lit(least)), "splits": F.col("small") >= min_size,
        "leaving": F.when(F.col("small") >= min_size, F.col("small") + F.col("large")).when(F.col("large") >= min_size, F.col("small"))
        .otherwise(F.col("small") + F.col("large")),
    })
    large = cut_lineage(large)
    above = large.select(F.col("rank").alias("parent"), F.col("splits").alias("born"), F.col("density").alias("birth"))
    placed = cut_lineage(large.join(above, "parent", "left").withColumn("born", F.col("parent").isNull() | F.col("born")))
    owner = climb(placed.select(F.col("rank").alias("x"), F.when(F.col("born"), F.col("rank")).otherwise(F.col("parent")).alias("up")))
    owner = owner.select(F.col("x").alias("rank"), F.col("up").alias("c"))
    births = placed.filter("born").select(
        F.col("rank").alias("c"), "parent", "label", (F.col("small") + F.col("large")).alias("size"), F.coalesce("birth", F.lit(0.0)).alias("birth")
    )
    parents = owner.select(F.col("rank").alias("parent"), F.col("c").alias("pc"))
    lost = large.join(owner, "rank").groupBy("c").agg(F.sum(F.col("leaving") * F.col("density")).alias("gone"), F.sum("leaving").alias("rows"))
    clusters = births.join(parents, "parent", "left").join(lost, "c").select(
        "c", "pc", "label", "size", "birth", (F.col("gone") - F.col("rows") * F.col("birth")).alias("own")
    )
    return cut_lineage(clusters), owner


def stable_clusters(clusters: DataFrame) -> DataFrame:
    """``(c, chosen)``: for every cluster of a condensed tree the chosen one that holds it, itself included, or null.

    Chosen are clusters at least as stable as all that can be had below them, none inside another. A cluster without a
    parent is chosen only if it never splits.
    """
    values = best_values(clusters)
    below = clusters.join(values, "c").filter("pc is not null").groupBy(F.col("pc").alias("c")).agg(F.sum("value").alias("below"))
    kept = clusters.join(below, "c", "left").select(
        "c", "pc", (F.col("below").isNull() | (F.col("pc").isNotNull() & (F.col("own") >= F.col("below")))).alias("keep")
    )
    # The topmost kept cluster on the way up, by doubling.
    state = cut_lineage(kept.select("c", F.col("pc").alias("up"), F.when(F.col("keep"), F.col("c")).alias("chosen")))
    while not state.filter("up is not null").isEmpty():
        ahead = state.select(F.col("c").alias("up"), F.col("up").alias("next"), F.col("chosen").alias("higher"))
        state = cut_lineage(state.join(ahead, "up", "left").select("c", F.col("next").alias("up"), F.coalesce("higher", "chosen").alias("chosen")))
    return state.select("c", "chosen")


def hierarchy_labels(forest: DataFrame, min_size: int, block: int = BLOCK) -> DataFrame:
    """``(v, label)``: vertices of a forest ``(src, dst, w)`` that belong to a stable cluster, named by its smallest vertex."""
    merges, firsts = merge_tree(forest, block)
    clusters, owner = condense(merges, min_size)
    held = stable_clusters(clusters).filter("chosen is not null")
    names = clusters.select(F.col("c").alias("chosen"), "label")
    # A vertex belongs to the first large merge above it.
    small = merges.filter(F.col("small") + F.col("large") < min_size).select(F.col("rank").alias("x"), F.col("parent").alias("up"))
    reached = climb(small.filter("up is not null"))
    placed = firsts.join(reached.select(F.col("x").alias("rank"), "up"), "rank", "left").select("v", F.coalesce("up", "rank").alias("rank"))
    return placed.join(owner, "rank").join(held, "c").join(names, "chosen").select("v", "label")


def linkage_cut(merges: DataFrame, at: Column | float) -> DataFrame:
    """Components ``(label, size)`` of two or more rows that edges up to a weight make, from the merges alone."""
    made = merges.filter(F.col("w") <= at).select("rank", "parent", "label", (F.col("small") + F.col("large")).alias("size"))
    return made.join(made.select(F.col("rank").alias("parent")), "parent", "left_anti").select("label", "size")
