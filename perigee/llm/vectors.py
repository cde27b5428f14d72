"""Near-duplicate vectors by an epsilon grid order join.

Vectors of one label lie in the order of their grid cells, the grid's side being the distance that the cosine asked for
allows, on leading principal dimensions. The order is cut into blocks, blocks into intervals of intervals. Starting
from whole labels, pairs of intervals are replaced by pairs of their parts, and a pair goes as soon as the boxes around
its vectors are farther apart than that distance, which proves all its pairs of vectors too far. Pairs of blocks that
are left are compared by matrix products in double precision.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perigee.llm.common import arrow_map, batch, components, n_buckets, store, table

BLOCK = 1024
FAN_OUT = 8
DIMENSIONS = 6
# Added to distances between boxes, for rounding in projections.
SLACK = 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def parsed_vectors(df: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """``(id, label, key, vec)``: doubles as bytes, and a key shared by equal vectors of one label.

    Key and vector are null where the label or vector is null, or the vector is empty, zero, or holds a null or a
    number that is not finite.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, vecs = [], []
            lists = b.column(2)
            for i, name in enumerate(b.column(1).to_pylist()):
                item = lists[i].values if lists[i].is_valid and name is not None else None
                x = None
                if item is not None and len(item) and not item.null_count:
                    x = item.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    big = np.abs(x).max()
                    if not np.isfinite(x).all() or big == 0 or not 1e-150 < big < 1e150:
                        # Numbers whose squares leave the range of doubles are scaled by a power of two, which is exact.
                        x = np.ldexp(x, -int(np.frexp(big)[1])) if np.isfinite(x).all() and big else None
                data = None if x is None else x.tobytes()
                vecs.append(data)
                keys.append(None if data is None else hashlib.blake2b(f"{name}|".encode() + data, digest_size=16).digest())
            yield batch(id=b.column(0), label=b.column(1), key=pa.array(keys, pa.binary()), vec=pa.array(vecs, pa.binary()))

    chosen = df.select(F.col(id_col).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    return arrow_map(chosen, run, f"id {chosen.schema['id'].dataType.simpleString()}, label string, key binary, vec binary")


def principal_axes(classes: DataFrame, k: int) -> dict[int, np.ndarray]:
    """The k leading axes of all unit vectors by their length, from second moments summed over all rows.

    A task adds up its rows' moments; only sums of d x d numbers for each length d of vectors reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, rows in by_length(b.column(0).to_pylist()):
                x = unit(rows[1])
                one = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                sums[d] = sums.get(d, 0) + one.T @ one
        for d, s in sums.items():
            yield batch(d=np.full(s.size, d), at=np.arange(s.size), v=s.ravel())

    summed = arrow_map(classes.select("vec"), run, "d bigint, at bigint, v double").groupBy("d", "at").agg(F.sum("v").alias("v"))
    cells = summed.orderBy("d", "at").toArrow().to_pandas()
    axes = {}
    for d, part in cells.groupby("d"):
        s = part["v"].to_numpy().reshape(d + 1, d + 1)
        mean = s[0, 1:] / s[0, 0]
        cov = s[1:, 1:] / s[0, 0] - np.outer(mean, mean)
        axes[int(d)] = np.linalg.eigh(cov)[1][:, ::-1][:, : min(k, int(d))]
    return axes


def by_length(vecs: list[bytes]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    sizes = np.array([len(v) // 8 for v in vecs], np.int64)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), (at, np.frombuffer(b"".join(vecs[i] for i in at), np.float64).reshape(len(at), d))


def grid_blocks(classes: DataFrame, epsilon: float, n_parts: int) -> DataFrame:
    """Blocks of the grid order: ``(part, label, lo, hi, cids, vecs)`` of up to BLOCK vectors of one label and length."""
    axes = principal_axes(classes, DIMENSIONS)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column(2).to_pylist()
            spots = np.zeros((len(vecs), DIMENSIONS))
            for d, (at, rows) in by_length(vecs):
                spots[at, : axes[d].shape[1]] = unit(rows) @ axes[d]
            cells = np.floor(spots / epsilon).astype(np.int64)
            names = [f"{n}/{len(v) // 8}" for n, v in zip(b.column(1).to_pylist(), vecs)]
            yield batch(
                cid=b.column(0), label=pa.array(names), vec=b.column(2), cell=pa.array(list(cells), pa.list_(pa.int64())),
                spot=pa.array(list(spots), pa.list_(pa.float64())),
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            spots = np.array([h[2] for h in held])
            return batch(
                block=np.array([(part << 32) + seq]), label=pa.array([held[0][1]]), lo=pa.array([spots.min(axis=0)], pa.list_(pa.float64())),
                hi=pa.array([spots.max(axis=0)], pa.list_(pa.float64())), cids=pa.array([np.array([h[0] for h in held], np.int64).tobytes()], pa.binary()),
                copies=pa.array([np.array([h[4] for h in held], np.int64).tobytes()], pa.binary()), vecs=pa.array([b"".join(h[3] for h in held)], pa.binary()),
            )

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (held[0][1] != row[1] or len(held) >= BLOCK):
                    yield block()
                    seq, held = seq + 1, []
                held.append(row)
        if held:
            yield block()

    placed = arrow_map(classes.select("cid", "label", "vec"), project, "cid bigint, label string, vec binary, cell array<bigint>, spot array<double>")
    placed = placed.join(classes.select("cid", "copies"), "cid")
    # Within a cell any order will do: by exact place, so that a crowded cell can be split between tasks.
    order = ["label", "cell", "spot", "cid"]
    placed = placed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    return arrow_map(
        placed.select("cid", "label", "spot", "vec", "copies"), cut,
        "block bigint, label string, lo array<double>, hi array<double>, cids binary, copies binary, vecs binary",
    )


def near_boxes(radius: float) -> Column:
    """Whether the boxes (alo, ahi) and (blo, bhi) come within the radius of each other."""
    below = F.zip_with("blo", "ahi", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    above = F.zip_with("alo", "bhi", lambda x, y: F.greatest(x - y, F.lit(0.0)))
    squares = F.aggregate(F.zip_with(below, above, lambda x, y: x * x + y * y), F.lit(0.0), lambda s, x: s + x)
    return squares <= radius * radius


def near_block_pairs(boxes: DataFrame, radius: float) -> DataFrame:
    """``(a, b)`` with a <= b of blocks of one label whose boxes are near, by descent through intervals of the order."""
    order = Window.partitionBy("label").orderBy("block")
    leaf = store(boxes.select("label", "block", "lo", "hi", (F.row_number().over(order) - 1).cast("long").alias("node")))
    most = leaf.agg(F.max("node")).first()[0]
    if most is None:
        return leaf.select(F.col("block").alias("a"), F.col("block").alias("b"))
    levels = [leaf.select("label", "node", "lo", "hi")]
    dims = range(DIMENSIONS)
    while FAN_OUT ** (len(levels) - 1) <= most:
        boxed = levels[-1].groupBy("label", F.floor(F.col("node") / FAN_OUT).cast("long").alias("node")).agg(
            F.array(*[F.min(F.col("lo")[i]) for i in dims]).alias("lo"), F.array(*[F.max(F.col("hi")[i]) for i in dims]).alias("hi")
        )
        levels.append(store(boxed))
    pairs = levels[-1].select("label", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        def side(name: str, level: DataFrame = level) -> DataFrame:
            up = F.floor(F.col("node") / FAN_OUT).cast("long").alias(name)
            return level.select("label", up, F.col("node").alias(f"{name}_node"), F.col("lo").alias(f"{name}lo"), F.col("hi").alias(f"{name}hi"))

        below = pairs.join(side("a"), ["label", "a"]).join(side("b"), ["label", "b"]).filter("a_node <= b_node").filter(near_boxes(radius))
        pairs = store(below.select("label", F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    name = leaf.select("label", F.col("node"), "block")
    first = name.select("label", F.col("node").alias("a"), F.col("block").alias("block_a"))
    second = name.select("label", F.col("node").alias("b"), F.col("block").alias("block_b"))
    return pairs.join(first, ["label", "a"]).join(second, ["label", "b"]).select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    return (a @ b.T) / np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)) >= cosine


def block_links(pairs: DataFrame, cosine: float) -> DataFrame:
    """From pairs of blocks: rows ``(cid, n, other)``, the number of vectors linked to cid, or an edge if other is set.

    Edges span the links of a pair of blocks, at most one per vector, so dense groups don't multiply.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for block_a, block_b, ids_a, ids_b, copies_a, copies_b, vecs_a, vecs_b in zip(*(c.to_pylist() for c in t.columns)):
                ca, cb = np.frombuffer(ids_a, np.int64), np.frombuffer(ids_b, np.int64)
                na, nb = np.frombuffer(copies_a, np.int64), np.frombuffer(copies_b, np.int64)
                x, y = np.frombuffer(vecs_a, np.float64).reshape(len(ca), -1), np.frombuffer(vecs_b, np.float64).reshape(len(cb), -1)
                hit = linked(x, y, cosine)
                same = block_a == block_b
                if same:
                    hit |= hit.T
                    np.fill_diagonal(hit, False)
                rows = np.flatnonzero(hit.any(axis=1))
                cid, n, other = [ca[rows]], [hit[rows] @ nb], [np.full(len(rows), -1)]
                if not same:
                    cols = np.flatnonzero(hit.any(axis=0))
                    cid, n, other = [*cid, cb[cols]], [*n, hit[:, cols].T @ na], [*other, np.full(len(cols), -1)]
                edges = np.array(span(hit, rows, same), np.int64).reshape(-1, 2)
                cid, n, other = [*cid, ca[edges[:, 0]]], [*n, np.zeros(len(edges), np.int64)], [*other, cb[edges[:, 1]]]
                yield batch(cid=np.concatenate(cid), n=np.concatenate(n), other=np.concatenate(other))

    return arrow_map(pairs.select("a", "b", "cids_a", "cids_b", "copies_a", "copies_b", "vecs_a", "vecs_b"), run, "cid bigint, n bigint, other bigint")


def span(hit: np.ndarray, rows: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Some of the links (row, column) that connect what all links connect."""
    edges = []
    left, columns = set(rows.tolist()), np.ones(hit.shape[1], bool)
    while left:
        queue = [left.pop()]
        while queue:
            row = queue.pop()
            new = np.flatnonzero(hit[row] & columns)
            columns[new] = False
            edges += [(row, int(c)) for c in new]
            if not len(new):
                continue
            if same:
                more = [int(c) for c in new if int(c) in left]
            else:
                more = [int(r) for r in rows[hit[np.ix_(rows, new)].any(axis=1)] if int(r) in left]
                # Rows that touch a column already reached need a link of their own to it.
                edges += [(r, int(new[np.argmax(hit[r, new])])) for r in more]
            left.difference_update(more)
            queue += more
    return edges


def near_vectors(df: DataFrame, cosine: float, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(id, n_links, component_id)`` per row; links join vectors of one label (and length) at the cosine or more.

    Rows without a usable vector link with nothing and are their own component. Equal vectors are one row of the join
    that counts as many. A component's number is its smallest identifier that is not null.
    """
    rows = store(parsed_vectors(df, id_col, vector, label))
    classes = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("id").alias("rep"), F.count("*").alias("copies")
    )
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()))
    epsilon = math.sqrt(2 - 2 * cosine)
    blocks = store(grid_blocks(classes, epsilon, n_buckets(classes.count(), 8 * BLOCK)))
    pairs = near_block_pairs(blocks.select("block", "label", "lo", "hi"), epsilon + SLACK)
    data = blocks.select("block", "cids", "copies", "vecs")
    left = data.select(F.col("block").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("cids", "copies", "vecs")])
    right = data.select(F.col("block").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("cids", "copies", "vecs")])
    met = store(block_links(pairs.join(left, "a").join(right, "b").repartition(n_buckets(pairs.count(), 4), "a", "b"), cosine))
    counts = met.filter("other < 0").groupBy("cid").agg(F.sum("n").alias("n"))
    groups = components(met.filter("other >= 0").select(F.col("cid").alias("a"), F.col("other").alias("b"))).select(F.col("v").alias("cid"), "c")
    named = store(classes.select("key", "cid", "rep", "copies").join(counts, "cid", "left").join(groups, "cid", "left").withColumn("c", F.coalesce("c", "cid")))
    firsts = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    result = named.join(firsts, "c").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = rows.select("id", "key").join(result, "key", "left")
    alone = F.col("key").isNull()
    return found.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def op10_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings"), 0.98)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


QUERIES = {"op10_epsilon_grid": op10_epsilon_grid}
