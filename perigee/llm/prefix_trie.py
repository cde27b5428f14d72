"""Prefix trie of conversations: a compacted trie whose nodes are found through hashed handles (a z-fast trie).

A prefix of a conversation is named by its depth and two 62-bit sums of hashes of its turns and their places, so the name
of any prefix of any conversation is one lookup in a table. A compacted node covers the depths (p, e] below its parent's
depth p. It is listed under the name of its path at one depth of them, the two-fattest number: the one that the highest
power of two divides. A conversation finds where it leaves the trie by fat binary search: it looks itself up at the
two-fattest depth of what is left, goes on from the end of the node it finds, or nearer to the top where it finds none.
That is a number of joins logarithmic in the depth, for all conversations at once.

Conversations are inserted in batches. In a batch all that leave the trie at the same place by the same turn send one of
them, drawn by hash; the others go on from there with the next batch. Drawn at random, it halves those that still share a
way with any other one, so batches are logarithmic in number. Equal conversations are one string from the start.

Sums over subtrees take as many rounds as the logarithm of the compacted depth: every node adds what it knows to the
ancestor 1, 2, 4, ... steps up. At the end edges are expanded to one row per depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, store, table
from perigee.session import broadcast_if_small

# Conversations that share a beginning stand in groups of 20, and take up to 3 turns of the first of them.
GROUP, BORROWED = 20, 4
MASK = (1 << 62) - 1
# Depths of an edge that one row stands for before edges are expanded; bytes of identifiers hashed at once; rows of results passed on at once.
EDGE, PIECE, ROWS = 1024, 1 << 20, 4096
NODE = "e bigint, ehi bigint, elo bigint, p bigint, rep bigint, f bigint, hi bigint, lo bigint, nhi bigint, nlo bigint"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def running_sums(df: DataFrame, key: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """The rows with ``sums`` replaced by their sums over the rows of the same key up to each, modulo 2**62, stored.

    Rows are cut into ranges of key and order, so that a key of any size is spread; tasks sum within their range, and one
    row for the first and last key of each range carries the totals on. Key and order must tell rows apart or be
    interchangeable; all key and summed columns are long and not null.
    """
    names = df.columns
    at = [names.index(k) for k in key]
    added = [names.index(s) for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None
        carry, last, first_run = np.zeros(len(sums), np.uint64), None, True

        def summed(b: pa.RecordBatch, final: bool) -> pa.RecordBatch:
            nonlocal carry, last, first_run
            keys = [np.asarray(b.column(i)) for i in at]
            n = b.num_rows - (not final)
            new = np.ones(n, bool)
            new[1:] = np.logical_or.reduce([k[1:n] != k[: n - 1] for k in keys])
            if last is not None:
                new[0] = tuple(k[0] for k in keys) != last
            end = np.ones(n, bool)
            end[: b.num_rows - 1] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])[:n]
            mark = np.zeros(n, np.int8)
            if first_run and end.any():
                mark[np.argmax(end)] = 1
                first_run = False
            if final:
                mark[-1] |= 2
            columns = [b.column(i).slice(0, n) for i in range(b.num_columns)]
            starts = np.flatnonzero(new)
            for j, i in enumerate(added):
                total = np.cumsum(np.asarray(columns[i]).astype(np.uint64), dtype=np.uint64)
                before = np.concatenate([np.zeros(1, np.uint64), total])
                base = np.zeros(n, np.uint64) - carry[j]
                if len(starts):
                    base[starts[0] :] = np.repeat(before[starts], np.diff(np.append(starts, n)))
                value = (total - base) & np.uint64(MASK)
                columns[i] = pa.array(value.astype(np.int64))
                carry[j] = value[-1]
            last = tuple(k[n - 1] for k in keys)
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(n, part, np.int32)), pa.array(mark)], names=[*names, "_range", "_mark"]
            )

        for b in batches:
            if held is not None:
                b = pa.concat_batches([held, b])
            if b.num_rows > 1:
                yield summed(b, False)
            held = b.slice(b.num_rows - 1) if b.num_rows else None
        if held is not None:
            yield summed(held, True)

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "_range int", "_mark tinyint"])
    columns = [*key, *order]
    rows = store(arrow_map(df.repartitionByRange(*columns).sortWithinPartitions(*columns), run, fields))
    offsets = carried(rows.filter("_mark > 0").select("_range", "_mark", *key, *sums).collect(), key, sums)
    plain = rows.drop("_range", "_mark")
    if not offsets:
        return plain
    side = df.sparkSession.createDataFrame(
        offsets, ", ".join(["_range int", *(f"`{k}` bigint" for k in key), *(f"`_{s}` bigint" for s in sums)])
    )
    # At most one row a range.
    joined = rows.join(F.broadcast(side), ["_range", *key], "left")
    return joined.select(*[
        (F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).bitwiseAND(F.lit(MASK)).alias(c) if c in sums else F.col(c) for c in names
    ])


def carried(rows: list, key: list[str], sums: list[str]) -> list[tuple]:
    """``(range, key, sums so far)`` where a range begins inside a key, from two rows a range."""
    out, last, total = [], None, [0] * len(sums)
    for r in sorted(rows, key=lambda r: (r["_range"], r["_mark"])):
        own = tuple(r[k] for k in key)
        values = [r[s] for s in sums]
        if r["_mark"] & 1 and own == last:
            out.append((r["_range"], *own, *total))
            values = [(v + t) & MASK for v, t in zip(values, total)]
        last, total = own, values
    return out


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    return F.expr(f"{high} & shiftleft(-1L, length(bin({low} ^ {high})) - 1)")


def digests(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, x, y, words)``: each turn by the two halves of the MD5 of ``<length of role>:<role><text>``; nulls are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, words = [], []
            for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                names.append(hashlib.md5(b"%d:%b%b" % (len(r), r, t)).digest())
                words.append(len(t.split()))
            halves = np.frombuffer(b"".join(names), ">i8").astype(np.int64).reshape(-1, 2)
            yield batch(conv=b.column(0), turn=b.column(1), x=halves[:, 0], y=halves[:, 1], words=np.array(words, np.int64))

    chosen = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("binary"), F.lit(b"")).alias(n) for c, n in ((role, "role"), (text, "text"))],
    )
    return arrow_map(chosen, run, "conv bigint, turn bigint, x bigint, y bigint, words bigint")


def rebuild(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and their turns ``(conv, d, x, y, words)``: the first turns of the group's first one, then their own."""
    base = F.col("conv") - F.col("conv") % GROUP
    wanted = (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).alias("h")
    convs = store(ranked.groupBy("conv").agg(F.lit(1).alias("_one")).select("conv", base.alias("base"), wanted))
    heads = store(ranked.filter((F.col("conv") % GROUP == 0) & (F.col("r") < BORROWED - 1)).withColumnRenamed("conv", "base"))
    held = broadcast_if_small(heads.groupBy("base").agg(F.count("*").alias("held")))
    own = ranked.withColumn("base", base).withColumn("h", wanted).filter("r >= h").join(held, "base", "left")
    own = own.select("conv", (F.least(F.col("h"), F.coalesce("held", F.lit(0))) + F.col("r") - F.col("h") + 1).alias("d"), "x", "y", "words")
    borrowed = convs.join(heads, "base").filter("r < h").select("conv", (F.col("r") + 1).alias("d"), "x", "y", "words")
    return convs.select("conv"), own.unionByName(borrowed)


def name_prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, d, hi, lo, total, words)``: the name of every prefix, and the words up to it and of its last turn."""
    hashed = turns.select(
        "conv", "d", F.xxhash64("x", "y", "d").bitwiseAND(F.lit(MASK)).alias("hi"), F.xxhash64("d", "y", "x", F.lit(1)).bitwiseAND(F.lit(MASK)).alias("lo"),
        F.col("words").alias("total"), "words",
    )
    return running_sums(hashed, ["conv"], ["d"], ["hi", "lo", "total"])


def at_depth(paths: DataFrame, s: str, d: str, hi: str, lo: str) -> DataFrame:
    return paths.select(F.col("conv").alias(s), F.col("d").alias(d), F.col("hi").alias(hi), F.col("lo").alias(lo))


def locate(pending: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """For ``(s, length, a)``, a the depth of a node that s passes: ``q``, where s leaves the trie, and the edge it leaves from, ``(e, ehi, elo, p, rep)``, null at a node."""
    handles = nodes.select("f", "hi", "lo", "e", "ehi", "elo")
    state = pending.select("s", "length", "a", F.col("length").alias("b"))
    while not state.filter("a < b").isEmpty():
        probe = state.filter("a < b").withColumn("f", two_fattest("a", "b")).join(at_depth(paths, "s", "f", "hi", "lo"), ["s", "f"])
        found = probe.join(handles, ["f", "hi", "lo"], "left").join(at_depth(paths, "s", "e", "xhi", "xlo"), ["s", "e"], "left")
        passed = F.coalesce((F.col("xhi") == F.col("ehi")) & (F.col("xlo") == F.col("elo")), F.lit(False))
        moved = found.select(
            "s", "length", F.when(passed, F.col("e")).otherwise(F.col("a")).alias("a"),
            # A handle that is met without its node being passed lies on the edge that s leaves from.
            F.when(passed, F.col("b")).when(F.col("e").isNull(), F.col("f") - 1).otherwise(F.col("a")).alias("b"),
        )
        state = store(moved.unionByName(state.filter("a >= b")))
    edges = nodes.select(F.col("nhi").alias("hi"), F.col("nlo").alias("lo"), (F.col("p") + 1).alias("d"), "e", "ehi", "elo", "p", "rep")
    on_edge = store(
        state.withColumn("d", F.col("a") + 1).join(at_depth(paths, "s", "d", "hi", "lo"), ["s", "d"]).join(edges, ["d", "hi", "lo"])
        .select("s", "length", "e", "ehi", "elo", "p", "rep")
    )
    mine = paths.select(F.col("conv").alias("s"), "d", "hi", "lo").join(on_edge.select("s", "p", "e", "rep"), "s").filter("d > p and d < e")
    theirs = paths.select(F.col("conv").alias("rep"), "d", "hi", "lo")
    shared = mine.join(theirs, ["rep", "d", "hi", "lo"]).groupBy("s").agg(F.max("d").alias("q"))
    return state.select("s", "length", "a").join(on_edge.drop("length"), "s", "left").join(shared, "s", "left").withColumn("q", F.coalesce("q", "a"))


def listed(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes given as ``(e, p, rep)`` with the names of their end, their handle and their first depth."""
    keyed = nodes.withColumn("f", two_fattest("p", "e"))
    depths = keyed.select("*", F.explode(F.array_distinct(F.array("e", "f", F.col("p") + 1))).alias("d"))
    named = depths.join(paths.select(F.col("conv").alias("rep"), "d", "hi", "lo"), ["rep", "d"])

    def pick(depth: Column, column: str, name: str) -> Column:
        return F.max(F.when(F.col("d") == depth, F.col(column))).alias(name)

    first = F.col("p") + 1
    return named.groupBy("e", "p", "rep", "f").agg(
        pick(F.col("e"), "hi", "ehi"), pick(F.col("e"), "lo", "elo"), pick(F.col("f"), "hi", "_hi"), pick(F.col("f"), "lo", "_lo"),
        pick(first, "hi", "nhi"), pick(first, "lo", "nlo"),
    ).select("e", "ehi", "elo", "p", "rep", "f", F.col("_hi").alias("hi"), F.col("_lo").alias("lo"), "nhi", "nlo")


def insert(nodes: DataFrame, pending: DataFrame, paths: DataFrame, first: bool) -> tuple[DataFrame, DataFrame]:
    """One batch: the trie with one more conversation for every place and turn that pending ones leave it by, and what is still pending."""
    if first:
        where = pending.withColumn("q", F.col("a")).withColumns({c: F.lit(None).cast("long") for c in ("e", "ehi", "elo", "p", "rep")})
    else:
        where = locate(pending, nodes, paths)
    where = store(where)
    leaving = where.filter("q < length").withColumn("d", F.col("q") + 1).join(at_depth(paths, "s", "d", "hi", "lo"), ["s", "d"])
    drawn = leaving.groupBy("d", "hi", "lo").agg(F.min(F.struct(F.xxhash64("s"), "s", "length", "q")).alias("one")).select("one.s", "one.length", "one.q")
    drawn = store(drawn)
    leaves = drawn.select(F.col("length").alias("e"), F.col("q").alias("p"), F.col("s").alias("rep"))

    # Edges are cut where conversations leave them or end on them; cuts of an edge are ranked to find the next one above.
    cuts = where.filter("e is not null and q > a").groupBy("e", "ehi", "elo", "p", "rep", "q").agg(F.lit(1).cast("long").alias("i"))
    ranked = running_sums(cuts, ["e", "ehi", "elo"], ["q"], ["i"])
    above = ranked.select("e", "ehi", "elo", F.col("q").alias("above"), (F.col("i") + 1).alias("i"))
    inner = ranked.join(above, ["e", "ehi", "elo", "i"], "left").select(F.col("q").alias("e"), F.coalesce("above", "p").alias("p"), "rep")
    lower = store(ranked.groupBy("e", "ehi", "elo", "rep").agg(F.max("q").alias("p")))
    fresh = leaves.unionByName(inner).unionByName(lower.select("e", "p", "rep"))
    kept = nodes.join(lower.select("e", "ehi", "elo"), ["e", "ehi", "elo"], "left_anti")
    grown = store(kept.select(*nodes.columns).unionByName(listed(fresh, paths)))
    left = where.filter("q < length").join(drawn.select("s"), "s", "left_anti").select("s", "length", F.col("q").alias("a"))
    return grown, store(left)


def build(strings: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes below the root of the compacted trie of ``(s, length)``, distinct sequences whose prefixes are in ``paths``."""
    spark = strings.sparkSession
    pending = store(strings.filter("length > 0").select("s", "length", F.lit(0).cast("long").alias("a")))
    nodes, first = spark.createDataFrame([], NODE), True
    while not pending.isEmpty():
        mine = paths if first else store(paths.join(pending.select(F.col("s").alias("conv")).unionByName(nodes.select(F.col("rep").alias("conv"))).distinct(), "conv", "left_semi"))
        nodes, pending = insert(nodes, pending, mine, first)
        first = False
    return nodes


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """Nodes ``(id, parent, ...)`` with ``n``, ``leaves``, ``ended`` and ``below`` summed, and ``least`` the minimum, over the subtree of each."""
    sums = ("n", "leaves", "ended", "below")
    state = nodes.select("id", F.col("parent").alias("up"), *sums, "least")
    while not state.filter("up is not null").isEmpty():
        given = state.filter("up is not null").groupBy(F.col("up").alias("id")).agg(
            *[F.sum(c).alias(f"_{c}") for c in sums], F.min("least").alias("_least")
        )
        higher = state.filter("up is not null").select(F.col("id").alias("up"), F.col("up").alias("next"))
        state = store(
            state.join(given, "id", "left").join(higher, "up", "left")
            .select("id", F.col("next").alias("up"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], F.least("least", "_least").alias("least"))
        )
    return state.drop("up")


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` of the identifiers ``(id, conv)``, ascending, in decimal, joined by commas.

    Ranges of the sorted identifiers are written out by many tasks; SHA-256 itself reads a node's pieces one after the
    other, so one task streams the text of a node without holding it.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        now, run, size, held, done = None, [], 0, 0, []

        def close() -> None:
            nonlocal number, run, size, held
            done.append((*now, part, number, ",".join(run)))
            number, held, run, size = number + 1, held + size, [], 0

        def finished() -> pa.RecordBatch:
            nonlocal held
            columns = [list(c) for c in zip(*done)]
            held = 0
            done.clear()
            return batch(**dict(zip(("e", "ehi", "elo", "place", "number"), columns)), text=columns[5])

        for b in batches:
            for *key, conv in zip(*[c.to_pylist() for c in b.columns]):
                if key != now or size > PIECE:
                    if run:
                        close()
                        if len(done) >= ROWS or held > PIECE:
                            yield finished()
                    now = key
                run.append(str(conv))
                size += len(run[-1]) + 1
        if run:
            close()
        if done:
            yield finished()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def finished() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*done)]
            done.clear()
            return batch(e=columns[0], ehi=columns[1], elo=columns[2], ends_sha256=columns[3])

        for b in batches:
            for *key, text in zip(*[b.column(i).to_pylist() for i in (0, 1, 2, 5)]):
                if key != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if len(done) >= ROWS:
                yield finished()
        if state is not None:
            done.append((*now, state.hexdigest()))
            yield finished()

    columns = ["e", "ehi", "elo", "conv"]
    sorted_ends = ends.select(*columns).repartitionByRange(*columns).sortWithinPartitions(*columns)
    pieces = arrow_map(sorted_ends, write, "e bigint, ehi bigint, elo bigint, place bigint, number bigint, text string")
    key = ["e", "ehi", "elo"]
    return arrow_map(pieces.repartition(*key).sortWithinPartitions(*key, "place", "number"), read, "e bigint, ehi bigint, elo bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, all columns long but the digest.

    Turns of a conversation are ordered by turn, nulls first, ties by their digests; repeated rows are turns of their own.
    Null role and text are empty. Rows without conversation belong to none and are left out. An empty table has no nodes,
    not even a root. Texts of any length count only as digests and words. Other columns are not read, whatever their names.
    """
    ranked = running_sums(
        digests(turns, conv, turn, role, text).withColumn("r", F.lit(1).cast("long")), ["conv"], ["turn", "x", "y"], ["r"]
    ).withColumn("r", F.col("r") - 1)
    convs, rebuilt = rebuild(ranked)
    prefixes = name_prefixes(rebuilt)
    last = prefixes.groupBy("conv").agg(F.max(F.struct("d", "hi", "lo", "total")).alias("last"))
    none = F.lit(0).cast("long")
    whole = store(convs.join(last, "conv", "left").select(
        "conv", *[F.coalesce(f"last.{c}", none).alias(n) for c, n in (("d", "e"), ("hi", "ehi"), ("lo", "elo"), ("total", "total"))]
    ))
    strings = store(whole.groupBy("e", "ehi", "elo").agg(F.min("conv").alias("s"), F.count("*").alias("own"), F.first("total").alias("total")))
    paths = store(prefixes.join(strings.select(F.col("s").alias("conv")), "conv", "left_semi"))
    nodes = build(strings.select("s", F.col("e").alias("length")), paths)

    # Parents by name, the words above and at the end of each edge, and what ends at each node.
    above = paths.select(F.col("conv").alias("rep"), F.col("d").alias("p"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("total").alias("before"))
    until = paths.select(F.col("conv").alias("rep"), F.col("d").alias("e"), F.col("total").alias("until"))
    placed = nodes.select("e", "ehi", "elo", "p", "rep").join(above, ["rep", "p"], "left").join(until, ["rep", "e"])
    root = strings.limit(1).select(*[none.alias(c) for c in ("e", "ehi", "elo")], *[F.lit(None).cast("long").alias(c) for c in ("p", "rep", "phi", "plo")], none.alias("before"), none.alias("until"))
    placed = placed.withColumns({c: F.coalesce(c, none) for c in ("phi", "plo", "before")}).unionByName(root)
    parent = F.when(F.col("p").isNotNull(), F.struct(F.col("p").alias("e"), F.col("phi").alias("ehi"), F.col("plo").alias("elo")))
    placed = placed.withColumn("id", F.struct("e", "ehi", "elo")).withColumn("parent", parent)
    children = placed.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    ended = strings.select(F.struct("e", "ehi", "elo").alias("id"), "own", "total", "s")
    known = store(placed.join(children, "id", "left").join(ended, "id", "left").select(
        "id", "parent", "p", "rep", "before", F.coalesce("children", none).alias("children"), F.coalesce("own", none).alias("n"),
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"), F.coalesce(F.col("own") * F.col("total"), none).alias("ended"),
        (F.col("until") - F.col("before")).alias("below"), F.col("s").alias("least"),
    ))
    sums = subtree_sums(known)
    upper = sums.select(F.col("id").alias("parent"), F.col("least").alias("parent_least"))
    digest = ends_digest(whole).select(F.struct("e", "ehi", "elo").alias("id"), "ends_sha256")
    full = store(known.select("id", "parent", "p", "rep", "before", "children").join(sums, "id").join(upper, "parent", "left").join(digest, "id", "left"))

    # Edges are expanded in blocks of depths first, so that a long edge is spread.
    top = F.when(F.col("p").isNull(), none).otherwise(F.col("p") + 1)
    blocks = full.withColumn("from", F.explode(F.sequence(top, F.col("id.e"), F.lit(EDGE).cast("long")))).repartition("id", "from")
    rows = blocks.withColumn("d", F.explode(F.sequence(F.col("from"), F.least(F.col("id.e"), F.col("from") + EDGE - 1))))
    depths = rows.join(paths.select(F.col("conv").alias("rep"), "d", "total", "words"), ["rep", "d"], "left")
    done = F.coalesce(F.col("total") - F.col("words"), none)
    end = F.col("d") == F.col("id.e")
    # Words counted for every conversation from this depth on, less those counted once for every node.
    saved = F.col("ended") - F.col("n") * done - (F.col("below") - (done - F.col("before")))
    return depths.select(
        F.col("least").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("p").isNotNull(), F.when(F.col("d") == F.col("p") + 1, F.col("parent_least")).otherwise(F.col("least"))).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(end, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.when(end, F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES = {
    "op13_prefix_trie": """
with tab as (
  select list(v order by i) as t from (
    select i, list_reduce([i]::bigint[] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[],
      lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i))
),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first) - 1 as r
  from conversations where conv_id is not null
),
convs as (
  select c, c - c % 20 as base,
    xor(list_reduce([4294967295]::bigint[] || list_transform(string_split(c::varchar, ''), lambda x: unicode(x)::bigint),
      lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) % 4 as h
  from (select distinct conv_id as c from turns), tab
),
rebuilt as (
  select c, row_number() over (partition by c order by own, r) as d, role, text from (
    select c, 0 as own, r, role, text from convs join turns on conv_id = base and r < h
    union all select c, 1, r, role, text from convs join turns on conv_id = c and r >= h)
),
prefixes as (
  select c, d, md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') over (partition by c order by d)) as name,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words
  from rebuilt
  union all select c, 0, 'root', 0 from convs
),
nodes as (select d, name, min(c) as conv, count(*) as n, max(words) as words from prefixes group by d, name),
lengths as (select c, max(d) as d from prefixes group by c),
ends as (
  select d, name, sha256(string_agg(c::varchar, ',' order by c)) as digest from lengths join prefixes using (c, d) group by d, name
),
edges as (
  select distinct p.d, p.name, u.name as up from prefixes p join prefixes u on u.c = p.c and u.d = p.d - 1
),
children as (select d - 1 as d, up as name, count(*) as k from edges group by all),
below as (
  select a.d, a.name, count(*) filter (where ch.k is null) as leaves, sum((n.n - 1) * n.words) as saved
  from nodes n join prefixes a on a.c = n.conv and a.d <= n.d left join children ch on ch.d = n.d and ch.name = n.name
  group by a.d, a.name
)
select n.conv as conv_id, n.d::bigint as depth, u.conv as parent_conv_id, n.n as n_convs, coalesce(c.k, 0)::bigint as n_children,
  b.leaves as n_leaves, b.saved::bigint as saved_tokens, coalesce(e.digest, sha256('')) as ends_sha256
from nodes n join below b using (d, name) left join edges g using (d, name) left join nodes u on u.d = n.d - 1 and u.name = g.up
  left join children c on c.d = n.d and c.name = n.name left join ends e on e.d = n.d and e.name = n.name
"""
}
