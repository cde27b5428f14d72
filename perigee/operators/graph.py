"""Graph steps as DataFrame iterations: minimum spanning forest, connected components, modularity communities.

Vertices are long keys. Every round ends in a checkpoint, so plans stay short and lost executors cost one round.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.session import cut_lineage


def _flatten_parents(parent: DataFrame) -> DataFrame:
    """Pointer jumping: replaces every parent by its root. ``parent`` is (c, p) with roots pointing to themselves."""
    while True:
        up = parent.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        parent = cut_lineage(parent.join(up, "p").select("c", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")))
        moved = parent.filter("moved").limit(1).count()
        parent = parent.drop("moved")
        if not moved:
            return parent


def spanning_forest(edges: DataFrame) -> DataFrame:
    """Minimum spanning forest of ``(src, dst, w)`` by Borůvka rounds: each component takes its lightest outgoing edge.

    Ties are broken by (w, src, dst), which makes the forest unique. Rounds work on a contracted graph with one edge
    per pair of components; their number is logarithmic in the number of vertices.
    """
    current = cut_lineage(edges.filter(F.col("src") != F.col("dst")).select(
        F.col("src").alias("a"), F.col("dst").alias("b"), F.struct("w", "src", "dst").alias("e")
    ))
    picked = []
    while current.limit(1).count():
        both = current.select("a", "b", "e").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b"), "e"))
        best = cut_lineage(both.groupBy("a").agg(F.min(F.struct("e", "b")).alias("m")).select("a", F.col("m.b").alias("b"), "m.e"))
        picked.append(best.select("e").distinct())
        # The picks form trees with one two-cycle each; the smaller end of that cycle becomes the root.
        back = best.select(F.col("a").alias("b"), F.col("b").alias("bb"))
        parent = best.join(back, "b").select(
            F.col("a").alias("c"),
            F.when((F.col("bb") == F.col("a")) & (F.col("a") < F.col("b")), F.col("a")).otherwise(F.col("b")).alias("p"),
        )
        root = _flatten_parents(cut_lineage(parent))
        moved = (
            current.join(root.select(F.col("c").alias("a"), F.col("p").alias("ra")), "a")
            .join(root.select(F.col("c").alias("b"), F.col("p").alias("rb")), "b").filter("ra != rb")
        )
        current = cut_lineage(
            moved.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("e").alias("e"))
        )
    forest = picked[0] if picked else current.select("e")
    for more in picked[1:]:
        forest = forest.unionByName(more)
    return forest.select("e.src", "e.dst", "e.w")


def components(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Connected components ``(*by, v, c)`` of ``(*by, src, dst)``, c being the smallest vertex; all ``by`` graphs at once.

    Rounds of hooking to the smallest neighbouring label and pointer jumping. Vertices without edges are absent.
    """
    by = list(by)
    ends = edges.select(*by, F.col("src").alias("v")).unionByName(edges.select(*by, F.col("dst").alias("v")))
    label = cut_lineage(ends.distinct().withColumn("c", F.col("v")))
    live = cut_lineage(edges.select(*by, F.col("src").alias("a"), F.col("dst").alias("b")).filter("a != b").distinct())
    while live.limit(1).count():
        both = live.unionByName(live.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(*by, "a").agg(F.min("b").alias("m")).select(
            *by, F.col("a").alias("c"), F.least("a", "m").alias("p")
        )
        parent = cut_lineage(parent)
        while True:
            up = parent.select(*by, F.col("c").alias("p"), F.col("p").alias("pp"))
            parent = cut_lineage(parent.join(up, [*by, "p"]).select(
                *by, "c", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")
            ))
            moved = parent.filter("moved").limit(1).count()
            parent = parent.drop("moved")
            if not moved:
                break
        label = cut_lineage(
            label.join(parent, [*by, "c"], "left").select(*by, "v", F.coalesce("p", "c").alias("c"))
        )
        left = parent.select(*by, F.col("c").alias("a"), F.col("p").alias("ra"))
        right = parent.select(*by, F.col("c").alias("b"), F.col("p").alias("rb"))
        live = cut_lineage(
            live.join(left, [*by, "a"]).join(right, [*by, "b"]).filter("ra != rb")
            .select(*by, F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
    return label


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row ``modularity`` for undirected ``(src, dst, w)`` edges (loops allowed) and ``(v, c)`` labels."""
    placed = edges.join(labels.select(F.col("v").alias("src"), F.col("c").alias("cs")), "src").join(
        labels.select(F.col("v").alias("dst"), F.col("c").alias("cd")), "dst"
    )
    total = placed.agg(F.sum("w").alias("m"), F.sum(F.when(F.col("cs") == F.col("cd"), F.col("w")).otherwise(0.0)).alias("inside"))
    ends = placed.select(F.col("cs").alias("c"), "w").unionByName(placed.select(F.col("cd").alias("c"), "w"))
    degree = ends.groupBy("c").agg(F.sum("w").alias("k"))
    squares = degree.agg(F.sum(F.col("k") * F.col("k"))).scalar()
    return total.select((F.col("inside") / F.col("m") - squares / (4 * F.col("m") * F.col("m"))).alias("modularity"))


def _half_move(state: DataFrame, links: DataFrame, m: float, half: int, seed: int) -> DataFrame:
    """Moves one hashed half of the vertices to their best neighbouring community; ``state`` is (v, c, k)."""
    totals = state.groupBy("c").agg(F.sum("k").alias("tot"))
    near = links.filter("src != dst").join(
        state.select(F.col("v").alias("dst"), F.col("c").alias("to")), "dst"
    ).select(F.col("src").alias("v"), "to", "w")
    # The vertex's own community is always an option, even without a link into it.
    options = near.unionByName(state.select("v", F.col("c").alias("to"), F.lit(0.0).alias("w"))).groupBy("v", "to").agg(
        F.sum("w").alias("into")
    )
    movers = state.filter(F.pmod(F.xxhash64(F.col("v"), F.lit(seed)), F.lit(2)) == half)
    scored = options.join(movers, "v").join(totals.withColumnRenamed("c", "to"), "to").withColumn(
        "gain", F.col("into") - F.col("k") * (
            F.col("tot") - F.when(F.col("to") == F.col("c"), F.col("k")).otherwise(F.lit(0.0))
        ) / (2 * m)
    )
    choice = scored.groupBy("v").agg(
        F.max_by("to", F.struct(F.round("gain", 9), (F.col("to") == F.col("c")).cast("int"), -F.col("to"))).alias("to")
    )
    return cut_lineage(state.join(choice, "v", "left").select("v", F.coalesce("to", "c").alias("c"), "k"))


def communities(edges: DataFrame, seed: int = 42) -> DataFrame:
    """Louvain communities ``(v, c)`` of an undirected graph ``(src, dst[, w])``.

    A sweep moves vertices to the neighbouring community with the largest modularity gain, one hashed half of the
    vertices after the other, so that neighbours do not swap places. A sweep that does not raise modularity is undone
    and ends its level. Settled communities are contracted to vertices and the next level starts. All ends when a level
    raises modularity no more; as every sweep raises it by a least step, that is sure to come.
    """
    weight: Column = F.col("w").cast("double") if "w" in edges.columns else F.lit(1.0)
    graph = cut_lineage(edges.select("src", "dst", weight.alias("w")))
    ends = graph.select(F.col("src").alias("v")).unionByName(graph.select(F.col("dst").alias("v")))
    final = cut_lineage(ends.distinct().select("v", F.col("v").alias("c")))
    m = graph.agg(F.sum("w")).first()[0]
    if not m:
        return final
    best = modularity(graph, final).first()[0]
    while True:
        start = best
        links = cut_lineage(graph.unionByName(graph.filter("src != dst").select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), "w"
        )))
        # A loop counts twice in its vertex's degree.
        degree = links.groupBy(F.col("src").alias("v")).agg(
            F.sum(F.when(F.col("src") == F.col("dst"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k")
        )
        state = cut_lineage(degree.select("v", F.col("v").alias("c"), "k"))
        for sweep in count():
            moved = _half_move(_half_move(state, links, m, 0, seed + sweep), links, m, 1, seed + sweep)
            reached = modularity(graph, moved).first()[0]
            if reached <= best + 1e-7:
                break
            best, state = reached, moved
        if best <= start + 1e-7:
            break
        merged = state.select(F.col("v").alias("c"), F.col("c").alias("to"))
        final = cut_lineage(final.join(merged, "c").select("v", F.col("to").alias("c")))
        src = state.select(F.col("v").alias("src"), F.col("c").alias("a"))
        dst = state.select(F.col("v").alias("dst"), F.col("c").alias("b"))
        graph = cut_lineage(
            graph.join(src, "src").join(dst, "dst")
            .groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).agg(F.sum("w").alias("w"))
        )
    return final
