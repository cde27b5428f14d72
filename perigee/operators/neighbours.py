"""Exact k-nearest-neighbour self-join in metric space, without a cross join.

Rows are grouped into cells around pivot points, and neighbouring cells into blocks of bounded size. Each block first
meets itself, which bounds every row's k-th distance; two blocks then meet, once for both directions, only with the rows
that the triangle inequality and the bisector between two pivots cannot exclude. A meeting screens all pairs by a matrix
product, whose rounding is allowed for, and computes the distances of those left one by one. Copies of one vector are
reduced to a representative first, so a vector shared by many rows costs one row in the search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.operators.distributed import hash_key
from perigee.session import cut_lineage

CELL_ROWS = 1024
# Rows and bytes of vectors in a block at most; a meeting holds two.
BLOCK_ROWS = 16_384
BLOCK_BYTES = 8 << 20
MAX_PIVOTS = 2048
# Rows and columns of the distances that are looked at together; rows against all pivots.
TILE_ROWS, TILE_COLUMNS, TOUR_ROWS = 512, 4096, 512
# Pairs whose distances are computed together, and pairs kept before they are reduced to the best.
EXACT_PAIRS, PENDING = 1 << 12, 1 << 20
MAX_TASKS = 1024

_PAIR = "gid bigint, nbr bigint, dist double"


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances by summed squared differences, one dimension at a time to keep memory flat."""
    out = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        gap = left[:, j, None] - right[None, :, j]
        out += gap * gap
    return np.sqrt(out)


def _pair_distances(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``_distances`` of the pairs ``left[i], right[j]`` alone, summed in the same order."""
    out = np.zeros(len(i))
    for at in range(0, len(i), EXACT_PAIRS):
        part = slice(at, at + EXACT_PAIRS)
        gap = left[i[part]] - right[j[part]]
        gap *= gap
        total = np.zeros(len(gap))
        for column in gap.T:
            total += column
        out[part] = np.sqrt(total)
    return out


def _factors(points: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left and right factor whose product holds squared distances up to rounding, and squared lengths."""
    near = points - centre
    square = np.einsum("ij,ij->i", near, near)[:, None]
    one = np.ones_like(square)
    return np.hstack([-2 * near, square, one]), np.hstack([near, one, square]), square[:, 0]


def _slack(left: np.ndarray, right: np.ndarray, dims: int) -> np.ndarray:
    """What a product of ``_factors`` may be off, for each squared length on the left."""
    return 32 * (dims + 8) * np.finfo(float).eps * (left + right.max(initial=0.0))


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix; a missing number is NaN. Rows of several lengths are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a row without a vector has no neighbours")
    numbers = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return numbers.reshape(len(column), len(numbers) // max(1, len(column)))


class _Best:
    """The ``k`` nearest residents of each visitor, ties by key; ``bound`` is what a further one may not exceed."""

    def __init__(self, bound: np.ndarray, k: int):
        self.bound, self.k = bound.copy(), k
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def limit(self, slack: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            limit = self.bound * np.abs(self.bound) * (1 + 1e-12) + slack
        return np.where(np.isnan(limit), np.inf, limit)

    def add(self, row: np.ndarray, key: np.ndarray, dist: np.ndarray) -> None:
        keep = np.isfinite(dist) & (dist <= self.bound[row])
        self.parts.append((row[keep], key[keep], dist[keep]))
        self.pending += int(keep.sum())
        if self.pending > PENDING:
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        row, key, dist = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((key, dist, row))
        row, key, dist = row[order], key[order], dist[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        last = place == self.k - 1
        self.bound[row[last]] = np.minimum(self.bound[row[last]], dist[last])
        best = place < self.k
        self.parts, self.pending = [(row[best], key[best], dist[best])], 0
        return self.parts[0]


def _meet_itself(keys: np.ndarray, points: np.ndarray, centre: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` nearest of every row of one block within it."""
    left, right, square = _factors(points, centre)
    slack, odd = _slack(square, square, points.shape[1]), not np.isfinite(square).all()
    found = []
    for at in range(0, len(keys), TILE_ROWS):
        rows = slice(at, at + TILE_ROWS)
        best = _Best(np.full(len(keys[rows]), np.inf), k)
        limit = None
        for start in range(0, len(keys), TILE_COLUMNS):
            columns = slice(start, start + TILE_COLUMNS)
            near = left[rows] @ right[columns].T
            if odd:
                near.fill(-np.inf)  # no screening among lengths that are no numbers
            if limit is None:
                # One of the k + 1 nearest of the first columns may be the row itself.
                limit = np.partition(near, k, axis=1)[:, k] + 2 * slack[rows] if near.shape[1] > k and not odd else np.full(len(near), np.inf)
            i, j = np.nonzero(near <= limit[:, None])
            other = keys[at + i] != keys[start + j]
            i, j = i[other], j[other]
            best.add(i, keys[start + j], _pair_distances(points[rows], points[columns], i, j))
            best.reduce()
            limit = np.minimum(limit, best.limit(2 * slack[rows]))
        row, key, dist = best.reduce()
        found.append((keys[at + row], key, dist))
    gid, nbr, dist = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(gid), pa.array(nbr), pa.array(dist)], ["gid", "nbr", "dist"])


def _meet_other(sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]], centre: np.ndarray, k: int) -> pa.RecordBatch:
    """The nearest of every row of two blocks in the other one, as far as its bound; ``sides`` have keys, vectors and bounds."""
    (a_keys, a, a_bound), (b_keys, b, b_bound) = sides
    left, _, a_square = _factors(a, centre)
    _, right, b_square = _factors(b, centre)
    a_slack, b_slack = _slack(a_square, b_square, a.shape[1]), _slack(b_square, a_square, a.shape[1])
    odd = not (np.isfinite(a_square).all() and np.isfinite(b_square).all())
    a_best, b_best = _Best(a_bound, k), _Best(b_bound, k)
    for at in range(0, len(a), TILE_ROWS):
        for start in range(0, len(b), TILE_COLUMNS):
            near = left[at:at + TILE_ROWS] @ right[start:start + TILE_COLUMNS].T
            if odd:
                near.fill(-np.inf)
            rows, columns = slice(at, at + len(near)), slice(start, start + near.shape[1])
            for best, own, limits in ((a_best, 0, a_best.limit(a_slack)[rows, None]), (b_best, 1, b_best.limit(b_slack)[None, columns])):
                i, j = np.nonzero(near <= limits)
                dist = _pair_distances(a[rows], b[columns], i, j)
                if own:
                    best.add(start + j, a_keys[at + i], dist)
                else:
                    best.add(at + i, b_keys[start + j], dist)
    found = [(keys[row], key, dist) for keys, (row, key, dist) in ((a_keys, a_best.reduce()), (b_keys, b_best.reduce()))]
    gid, nbr, dist = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(gid), pa.array(nbr), pa.array(dist)], ["gid", "nbr", "dist"])


def _meetings(rows: DataFrame, n: int, meet: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """Runs ``meet`` on the rows of each of the meetings 0..n-1, told by ``dest >> 2``; a task holds one meeting at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = -1
        for b in batches:
            ids = b.column("dest").to_numpy() >> 2
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for s, e in zip(cuts, cuts[1:]):
                if e > s:
                    if held and ids[s] != now:
                        yield meet(pa.Table.from_batches(held))
                        held.clear()
                    now = ids[s]
                    held.append(b.slice(s, e - s))
        if held:
            yield meet(pa.Table.from_batches(held))

    tasks = min(n, MAX_TASKS)
    dealt = rows.repartitionById(tasks, F.pmod(F.shiftright("dest", 2), F.lit(tasks)).cast("int")).sortWithinPartitions("dest")
    return dealt.mapInArrow(run, _PAIR)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("gid").orderBy("dist", "nbr")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _chained(between: np.ndarray) -> list[int]:
    """An order of the pivots in which each comes after one that is near."""
    out, free = [0], np.ones(len(between), bool)
    free[0] = False
    for _ in range(len(between) - 1):
        gap = np.where(free, np.nan_to_num(between[out[-1]], nan=np.finfo(float).max), np.inf)
        gap[free] = np.minimum(gap[free], np.finfo(float).max)
        out.append(int(gap.argmin()))
        free[out[-1]] = False
    return out


def _blocks(sizes: np.ndarray, order: list[int], most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of each cell, and the number of blocks: of whole cells in a row, or parts of a crowded cell."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, held = 0, 0
    for cell in order:
        size = int(sizes[cell])
        if held and held + size > most:
            block, held = block + 1, 0
        first[cell], held = block, held + size
        if size > most:
            parts[cell] = -(-size // most)
            block, held = block + int(parts[cell]), 0
    return first, parts, block + (held > 0)


def _knn_distinct(points: DataFrame, k: int, n: int, cell_rows: int) -> DataFrame:
    """k nearest distinct vectors of every distinct vector: (gid, nbr, dist, rank)."""
    spark = points.sparkSession
    n_pivots = min(MAX_PIVOTS, max(1, n // cell_rows))
    pivots = np.array([
        r["vec"] for r in points.orderBy(hash_key("gid", "_pivot"), "gid").limit(n_pivots).collect()  # <= MAX_PIVOTS
    ], float)
    if not len(pivots):
        return spark.createDataFrame([], f"{_PAIR}, rank int")
    between, dims = _distances(pivots, pivots), pivots.shape[1]
    centre = np.nan_to_num(pivots.mean(axis=0), nan=0.0, posinf=0.0, neginf=0.0)
    shared = spark.sparkContext.broadcast((pivots, between, centre))

    def squares(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to all pivots, which may be off by the second array."""
        pivots, _, centre = shared.value
        left, _, square = _factors(vec, centre)
        _, right, far = _factors(pivots, centre)
        return left @ right.T, _slack(square, far, dims)[:, None]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), TOUR_ROWS):
                rows = b.slice(at, TOUR_ROWS)
                vec = _vectors(rows.column("vec"))
                cell = np.nan_to_num(squares(vec)[0], nan=np.inf, posinf=np.inf).argmin(axis=1)
                reach = _pair_distances(vec, shared.value[0], np.arange(len(vec)), cell)
                yield pa.RecordBatch.from_arrays([rows.column("gid"), rows.column("vec"), pa.array(cell.astype(np.int32)), pa.array(reach)], ["gid", "vec", "cell", "reach"])

    placed = cut_lineage(points.select("gid", "vec").mapInArrow(place, "gid bigint, vec array<double>, cell int, reach double"))
    size, radius = np.zeros(len(pivots), np.int64), np.full(len(pivots), -np.inf)
    for row in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect():  # one row per pivot
        size[row["cell"]], radius[row["cell"]] = row["n"], row["radius"]
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dims)), max(2 * cell_rows, n // 8)))
    first, parts, n_blocks = _blocks(size, _chained(between), most)

    def block_of(gid: np.ndarray, cell: np.ndarray) -> np.ndarray:
        mixed = (gid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return first[cell] + (mixed % parts[cell].astype(np.uint64)).astype(np.int64)

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dest = block_of(b.column("gid").to_numpy(), b.column("cell").to_numpy()) << 2
            yield pa.RecordBatch.from_arrays([b.column("gid"), b.column("vec"), pa.array(dest)], ["gid", "vec", "dest"])

    def itself(rows: pa.Table) -> pa.RecordBatch:
        return _meet_itself(rows.column("gid").to_numpy(), _vectors(rows.column("vec")), shared.value[2], k)

    own = placed.mapInArrow(by_block, "gid bigint, vec array<double>, dest bigint")
    local = _best(_meetings(own, n_blocks, itself), k)
    if n_blocks == 1:
        return local
    local = cut_lineage(local)
    kth = local.filter(F.col("rank") == k).select("gid", F.col("dist").alias("bound"))
    bounded = cut_lineage(placed.join(kth, "gid", "left").select("gid", "vec", "cell", "reach", F.coalesce("bound", F.lit(float("inf"))).alias("bound")))
    # Blocks that hold rows of a cell.
    holds = np.zeros((n_blocks, len(pivots)), bool)
    for cell in np.flatnonzero(size):
        holds[first[cell]:first[cell] + parts[cell], cell] = True

    def needed(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell and block of each row, and the cells that may hold one of its nearest."""
        cell, home, bound = (rows.column(c).to_numpy() for c in ("cell", "reach", "bound"))
        square, slack = squares(_vectors(rows.column("vec")))
        gap = shared.value[1][cell]
        with np.errstate(all="ignore"):
            far = np.sqrt(np.maximum(square - slack, 0.0))
            bisector = (square - slack - home[:, None] ** 2) / (2 * gap)
            lower = np.maximum(far - radius[None, :], np.where(gap > 0, bisector, 0.0))
            # A hair of slack keeps rounding from excluding an equal distance.
            go = ~(lower > bound[:, None] + 1e-9 * (1 + far)) & (size > 0)[None, :]
        return cell, block_of(rows.column("gid").to_numpy(), cell), go

    def wants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want = np.zeros((n_blocks, len(pivots)), bool)
        for b in batches:
            for at in range(0, len(b), TOUR_ROWS):
                _, block, go = needed(b.slice(at, TOUR_ROWS))
                for x in np.unique(block):
                    want[x] |= go[block == x].any(axis=0)
        x, cell = np.nonzero(want)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(cell)], ["block", "cell"])

    want = np.zeros((n_blocks, len(pivots)), bool)
    for row in bounded.mapInArrow(wants, "block bigint, cell bigint").distinct().collect():  # at most blocks x pivots
        want[row["block"], row["cell"]] = True
    visits = want.astype(np.int32) @ holds.T.astype(np.int32) > 0
    ones, twos = np.nonzero(np.triu(visits | visits.T, 1))
    if not len(ones):
        return local
    number = np.full((n_blocks, n_blocks), -1, np.int64)
    number[ones, twos] = number[twos, ones] = np.arange(len(ones))
    plan = spark.sparkContext.broadcast((want, holds.T.astype(np.float32), number))

    def travel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with its meetings: as one that visits (bit 0) or for others alone, on the first or second side (bit 1)."""
        want, holds, number = plan.value
        for b in batches:
            for at in range(0, len(b), TOUR_ROWS):
                rows = b.slice(at, TOUR_ROWS)
                cell, block, go = needed(rows)
                visiting = go.astype(np.float32) @ holds > 0
                meets = (visiting | want[:, cell].T) & (number[block] >= 0)
                i, other = np.nonzero(meets)
                dest = number[block[i], other] << 2 | (block[i] > other).astype(np.int64) << 1 | visiting[i, other]
                offsets = np.concatenate([[0], np.cumsum(meets.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([rows.column("gid"), rows.column("vec"), rows.column("bound"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(dest))], ["gid", "vec", "bound", "dests"])

    def others(rows: pa.Table) -> pa.RecordBatch:
        dest, gid = rows.column("dest").to_numpy(), rows.column("gid").to_numpy()
        bound, vec = np.where(dest & 1, rows.column("bound").to_numpy(), -np.inf), _vectors(rows.column("vec"))
        return _meet_other([(gid[s], vec[s], bound[s]) for s in ((dest & 2) == 0, (dest & 2) > 0)], shared.value[2], k)

    sent = bounded.mapInArrow(travel, "gid bigint, vec array<double>, bound double, dests array<bigint>").select("gid", "vec", "bound", F.explode("dests").alias("dest"))
    abroad = _meetings(sent, len(ones), others)
    return _best(local.select("gid", "nbr", "dist").unionByName(abroad), k)


def knn_join(df: DataFrame, id_col: str, vec_col: str, k: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges ``(id, nbr, rank, dist)``: the exact k nearest other rows of each row, ties by key."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    groups = rows.groupBy("vec").agg(F.min("id").alias("gid"), F.count("*").alias("copies"))
    groups = cut_lineage(groups)
    tally = groups.agg(F.count("*").alias("groups"), F.coalesce(F.max("copies"), F.lit(0)).alias("most")).first()
    points = groups.select("gid", "vec")
    found = _knn_distinct(points, k, tally["groups"], cell_rows)
    if tally["most"] <= 1:
        return found.select(F.col("gid").alias("id"), "nbr", F.col("rank"), "dist")

    # Rows sharing a vector: the k+1 smallest keys of each group stand for it (one of them may be the row itself).
    first = Window.partitionBy("vec").orderBy("id")
    heads = (
        rows.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= k + 1)
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("heads"))  # at most k + 1 keys
        .select(F.col("heads")[0].alias("other"), "heads")
    )
    # Candidate lists per group: own copies at distance 0, then the members of the k nearest groups, k + 1 in all.
    nearby = found.select("gid", F.col("nbr").alias("other"), "dist").unionByName(
        points.select("gid", F.col("gid").alias("other"), F.lit(0.0).alias("dist"))
    )
    listed = nearby.join(heads, "other").select("gid", "dist", F.explode("heads").alias("nbr"))
    best = Window.partitionBy("gid").orderBy("dist", "nbr")
    lists = (
        listed.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k + 1)
        .groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("dist", "nbr"))).alias("c"))  # k + 1 entries
    )
    # Every row takes its group's list without itself: one list per group, so copies never meet each other.
    out = rows.join(points.join(lists, "gid").select("vec", "c"), "vec").select(
        "id", F.slice(F.filter("c", lambda x: x["nbr"] != F.col("id")), 1, k).alias("c")
    )
    return out.select("id", F.posexplode("c").alias("pos", "x")).select(
        "id", F.col("x.nbr").alias("nbr"), (F.col("pos") + 1).alias("rank"), F.col("x.dist").alias("dist")
    )


def knn_graph(edges: DataFrame, src: str = "id", dst: str = "nbr") -> DataFrame:
    """Undirected simple graph ``(src, dst)`` with src < dst: both directions of a pair count once, no self-loops."""
    return edges.filter(F.col(src) != F.col(dst)).select(
        F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst")
    ).distinct()
