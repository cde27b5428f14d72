"""Near-duplicates: SimHash fingerprints within a few bits, and texts whose sets of shingles are similar.

``link_close`` finds all pairs of 64-bit fingerprints that differ in few bits, exactly: split into one block more than
may differ, a close pair has an equal block. Rows that share a block meet in one run of a sorted partition, and only a
spanning forest of a run's links is passed on, never all its pairs.

``link_similar`` is for similarities that 64 bits cannot tell. Wide fingerprints of the sets of shingles are looked up in
tables by some of their bits each, as many tables as the recall at the similarity needs; pairs that meet and whose
fingerprints are close are decided by the shingle sets themselves. Nothing is gathered by key: pairs come from
joins, and pairs that links already found make needless are not looked at.

Equal fingerprints, or equal sets, are one row before anything is joined.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, components, mix64, raw_texts, store, table, text_bytes, with_text
from perigee.session import free_shuffles, scratch_path, scratch_scope

SEED = 42
# Longest run of equal blocks that is compared in one go; longer ones are split by further blocks first. Not below 16,
# as so few distinct rows may be left where there are no more bits to split by.
RUN = 2048
CHUNK = 1 << 12
# Bits of a set's fingerprint; of them in a sketch; tables dealt at once; rounds of pairs with one text a key.
WIDE, SKETCH, TABLES, STARS = 1024, 128, 20, 2
# Bits of a table's key follow the number of sets, so that a key has few unlike ones; and are so many at least.
LEAST_BITS = 16
# Keys of up to so many sets are dropped if no two of their sketches are close.
CHANCE = 8
# Sets of up to so many shingles have too few for the bits to follow the angle; they meet by shingles.
FEW = 20
# Byte -> its bits as the lowest bits of eight bytes, so that one addition counts eight bits.
SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words in lower case, repeats included; of all words if they are fewer."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    if len(words) <= size:
        spans = [(0, len(line))]
    else:
        spans = zip([0, *[e + 1 for e in ends[: len(words) - size]]], ends[size - 1 :])
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(line[s:e], SEED) for s, e in spans]), ">u8").astype(np.uint64)


def fingerprint(hashes: np.ndarray, n_words: int) -> bytes:
    """Majority of every bit over the hashes, little-endian; further words come from remixed hashes."""
    counts = np.zeros(64 * n_words, np.int64)
    for at in range(0, len(hashes), CHUNK):
        h = hashes[at : at + CHUNK]
        wide = h[:, None] if n_words == 1 else np.concatenate(
            [h[:, None], mix64(h[:, None] + np.arange(1, n_words, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))], axis=1
        )
        bits = SPREAD[np.ascontiguousarray(wide).view(np.uint8)]
        sums = np.add.reduceat(bits, np.arange(0, len(h), 255), axis=0)
        counts += sums.view(np.uint8).astype(np.int64).sum(axis=0)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes()


def with_fingerprints(docs: DataFrame, keep: list[str], shingle: int, n_words: int = 1, distinct: bool = False, text: str = "text") -> DataFrame:
    """``keep`` and ``_fp``, 8 bytes per word, and if shingles count once, 8 more with their number. A text without words, null included, has the fingerprint zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw in b.column(b.num_columns - 1).to_pylist():
                h = shingle_hashes(raw, shingle)
                if distinct:
                    h = np.unique(h)
                out.append(fingerprint(h, n_words) + (len(h).to_bytes(8, "little") if distinct else b""))
            yield batch(**{c: b.column(i) for i, c in enumerate(keep)}, _fp=pa.array(out, pa.binary()))

    chosen = docs.select(*[F.col(c) for c in keep], text_bytes(text).alias("__text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]), "_fp binary"])
    return arrow_map(chosen, run, fields)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: int, limit: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, bool]]:
    """Runs of equal leading ``keys`` columns over the batches of a sorted partition: ``(columns, run starts, long)``.

    Rows of runs longer than ``limit`` come as pieces marked long; all others in groups of whole runs.
    """
    held: list[np.ndarray] | None = None
    long_key = None
    for b in batches:
        cols = [to_numpy(c) for c in b.columns]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        n = len(cols[0])
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:keys]])
        starts = np.flatnonzero(new)
        if long_key is not None and tuple(c[0] for c in cols[:keys]) == long_key:
            end = starts[1] if len(starts) > 1 else n
            yield [c[:end] for c in cols], np.array([0]), True
            cols, starts = [c[end:] for c in cols], starts[1:] - end
        long_key = None if len(starts) else long_key
        if not len(starts):
            held = None
            continue
        last = starts[-1]
        if last:
            yield from split_long([c[:last] for c in cols], starts[:-1], limit)
        held = [c[last:] for c in cols]
        if len(held[0]) > limit:
            yield held, np.array([0]), True
            long_key, held = tuple(c[0] for c in held[:keys]), None
    if held is not None:
        yield from split_long(held, np.array([0]), limit)


def split_long(cols: list[np.ndarray], starts: np.ndarray, limit: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, bool]]:
    sizes = np.diff(np.append(starts, len(cols[0])))
    if (sizes > limit).any():
        for k in np.flatnonzero(sizes > limit):
            yield [c[starts[k] : starts[k] + sizes[k]] for c in cols], np.array([0]), True
        keep = np.repeat(sizes <= limit, sizes)
        cols, sizes = [c[keep] for c in cols], sizes[sizes <= limit]
        starts = np.cumsum(sizes) - sizes
    if len(starts):
        yield cols, starts, False


def to_numpy(column: pa.Array) -> np.ndarray:
    if pa.types.is_binary(column.type):
        values = column.to_pylist()
        return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1) if values else np.empty((0, 1), np.uint64)
    return column.to_numpy(zero_copy_only=False)


def forest(m: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of m items; ``near(i, others)`` tells which of the others i is linked to.

    An item is compared only with those not reached yet, so a run of mutual near-copies costs one comparison each.
    """
    rest, edges = np.arange(m), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            if hit.any():
                reached = rest[hit]
                rest = rest[~hit]
                edges += [(i, int(j)) for j in reached]
                queue += reached.tolist()
    return edges


def within(starts: np.ndarray, n: int, at_most: int, check: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) of rows in runs of up to ``at_most`` rows that pass ``check``; vectorised over runs."""
    sizes = np.diff(np.append(starts, n))
    small = sizes <= at_most
    ends = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(np.repeat(small & (sizes > 1), sizes))
    left, right = [], []
    for step in range(1, at_most):
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            break
        hit = rows[check(rows, rows + step)]
        left.append(hit)
        right.append(hit + step)
    empty = np.empty(0, np.int64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


SMALL_RUN = 8


def block_masks(path: int, blocks: int) -> list[tuple[int, int]]:
    """``(path, mask)`` of the blocks that follow ``path``: bits not yet fixed by it, in order, in equal parts."""
    fixed, steps = 0, []
    while path > 1:
        steps.append(path % blocks)
        path //= blocks
    trail = 1
    for step in reversed(steps):
        fixed |= parts(fixed, blocks)[step]
        trail = trail * blocks + step
    return [(trail * blocks + i, fixed | part) for i, part in enumerate(parts(fixed, blocks))]


def parts(fixed: int, blocks: int) -> list[int]:
    free = [i for i in range(64) if not fixed >> i & 1]
    cuts = [len(free) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]


def keyed(fp: np.ndarray, path: int, blocks: int) -> pa.RecordBatch:
    """A row per block after ``path``: the path with that block and all bits fixed so far."""
    masks = block_masks(path, blocks)
    unsigned = fp.view(np.uint64)
    return batch(
        a=np.concatenate([(unsigned & np.uint64(mask)).view(np.int64) for _, mask in masks]), b=np.tile(fp, len(masks)),
        path=np.repeat(np.array([p for p, _ in masks], np.int64), len(fp)),
    )


def link_close(fps: DataFrame, radius: int) -> DataFrame:
    """``(a, b)`` of a graph on the distinct 64-bit ``fp`` whose components are those of all pairs within ``radius`` bits.

    With ``radius + 1`` blocks, a close pair agrees in one. A run that is too long is dealt out again by further blocks
    of the remaining bits, where the same holds, until every run is short; no pair is lost on the way.
    """
    blocks = radius + 1
    schema = "a bigint, b bigint, path bigint"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield keyed(b.column(0).to_numpy(zero_copy_only=False), 1, blocks)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, _, fp), starts, is_long in sorted_runs(batches, 2, RUN):
            if is_long:
                yield keyed(fp, int(path[0]), blocks)
                continue
            bits = fp.view(np.uint64)
            left, right = within(starts, len(fp), SMALL_RUN, lambda i, j: np.bitwise_count(bits[i] ^ bits[j]) <= radius)
            pairs = [(fp[left], fp[right])]
            for s, e in zip(starts, np.append(starts[1:], len(fp))):
                if e - s > SMALL_RUN:
                    x = bits[s:e]
                    edges = forest(e - s, lambda i, rest: np.bitwise_count(x[i] ^ x[rest]) <= radius)
                    if edges:
                        i, j = np.array(edges).T
                        pairs.append((fp[s:e][i], fp[s:e][j]))
            a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            yield batch(a=a, b=b, path=np.zeros(len(a), np.int64))

    rows, edges = arrow_map(fps.select("fp"), first, schema), None
    while True:
        dealt = rows.select("path", "a", F.col("b").alias("fp"))
        dealt = dealt.repartition("path", "a").sortWithinPartitions("path", "a", "fp")
        done = store(arrow_map(dealt, compare, schema))
        found = done.filter("path = 0").select("a", "b")
        edges = found if edges is None else edges.unionByName(found)
        rows = done.filter("path <> 0")
        if not rows.limit(1).count():
            return edges


def differing(similarity: float) -> float:
    """The share of differing bits of two sets of the similarity: by their angle if of one size, where it is largest, and up to 5 % more for ties."""
    return 1.05 * math.acos(2 * similarity / (1 + similarity)) / math.pi


def most_differing(similarity: float, bits: int) -> int:
    p = differing(similarity)
    return math.floor(bits * p + 4 * math.sqrt(bits * p * (1 - p)))


def table_count(similarity: float, recall: float, bits: int) -> int:
    """Tables keyed by ``bits`` of a fingerprint each so that a pair of the similarity has an equal key with the recall.

    Tables share the fingerprint's bits, so the recall is a mean over how many of them differ.
    """
    p, z = differing(similarity), np.linspace(-4, 4, 81)
    weight = np.exp(-z * z / 2) / np.exp(-z * z / 2).sum()
    missed = 1 - np.clip(1 - p - z * math.sqrt(p * (1 - p) / WIDE), 0, 1) ** bits
    count = 1
    while weight @ missed**count > 1 - recall:
        count += 1
    return count


def key_tables(similarity: float, recall: float, rows: int) -> list[np.ndarray]:
    """The places of the bits of each table."""
    bits = min(32, max(LEAST_BITS, rows.bit_length()))
    rng = np.random.default_rng(SEED)
    return [rng.choice(WIDE, bits, replace=False) for _ in range(table_count(similarity, recall, bits))]


def table_keys(fps: np.ndarray, tables: list[np.ndarray], first: int) -> np.ndarray:
    """``[row, table]`` from fingerprints as rows of bytes; ``first`` numbers the tables."""
    bits = np.unpackbits(fps, axis=1, bitorder="little")
    value = np.stack([bits[:, t] @ (np.int64(1) << np.arange(len(t))) for t in tables], axis=1).astype(np.uint64)
    return mix64(value + (np.arange(first, first + len(tables), dtype=np.uint64) << np.uint64(32)))


def with_signatures(docs: DataFrame, keep: list[str], shingle: int, similarity: float, text: str) -> DataFrame:
    """``keep``; ``_set``, which names the set of shingles; ``_n``, its size; its fingerprint and a sketch of the first bits of it;
    ``_few``, of a small set the shingles of which a similar set has at least one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, sizes, fps, few = [], [], [], []
            for raw in raw_texts(b, at):
                h = np.unique(shingle_hashes(raw, shingle))
                names.append(xxhash.xxh3_128_digest(h.tobytes()))
                sizes.append(len(h))
                fps.append(fingerprint(h, WIDE // 64))
                few.append(h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1].view(np.int64) if len(h) <= FEW else [])
            sketch = np.frombuffer(b"".join(fps), np.int64).reshape(b.num_rows, -1)
            yield batch(
                **{c: b.column(i) for i, c in enumerate(keep)}, _set=pa.array(names, pa.binary()), _n=pa.array(sizes, pa.int64()),
                _s0=sketch[:, 0].copy(), _s1=sketch[:, 1].copy(), _fp=pa.array(list(sketch), pa.list_(pa.int64())), _few=pa.array(few, pa.list_(pa.int64())),
            )

    chosen, at = with_text(docs, keep, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keep)])
    return arrow_map(chosen, run, f"{fields}, _set binary, _n bigint, _s0 bigint, _s1 bigint, _fp array<bigint>, _few array<bigint>")


def dealt_keys(fps: DataFrame, similarity: float, tables: list[np.ndarray], first: int) -> DataFrame:
    """``(fid, key, bits)``: a row per set and table, with bits of its sketch; small sets come by shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            many = b.filter(pa.array(b.column(1).to_numpy() > FEW * similarity))
            if many.num_rows:
                raw = many.column(3).flatten().to_numpy().view(np.uint8).reshape(many.num_rows, -1)
                keys = table_keys(raw, tables, first)
                yield batch(
                    fid=np.repeat(many.column(0).to_numpy(), len(tables)), key=keys.ravel().view(np.int64), bits=np.repeat(many.column(2).to_numpy(), len(tables))
                )

    dealt = arrow_map(fps.select("fid", "n", "s0", "fp"), run, "fid bigint, key bigint, bits bigint")
    if first:
        return dealt
    return dealt.unionByName(fps.select("fid", F.explode("few").alias("key"), F.lit(0).cast("bigint").alias("bits")))


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``(fid, words)`` from ``(fid, raw)``: the distinct hashes of a text's shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(raw, shingle)).view(np.int64) for raw in b.column(1).to_pylist()]
            yield batch(fid=b.column(0), words=pa.array(sets, pa.list_(pa.int64())))

    return arrow_map(texts.select("fid", "raw"), run, "fid bigint, words array<bigint>")


def unshared(texts: DataFrame, shingle: int) -> DataFrame:
    """``(fid, alone)``: how many of a text's distinct shingles are in no other of the texts; none are left out as zero."""
    words = shingle_sets(texts, shingle).select("fid", F.explode("words").alias("word"))
    once = words.groupBy("word").agg(F.count("*").alias("n"), F.min("fid").alias("fid")).filter("n = 1")
    return once.groupBy("fid").agg(F.count("*").alias("alone"))


def truly_similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets of shingles have the similarity or more. Joined by shuffle at every size, as the sets grow with the data."""
    both = pairs.join(sets.select(F.col("fid").alias("b"), F.col("words").alias("y")).hint("merge"), "b")
    both = both.join(sets.select(F.col("fid").alias("a"), F.col("words").alias("x")).hint("merge"), "a")
    sized = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("sizes"))
    return sized.filter(F.col("shared") / (F.col("sizes") - F.col("shared")) >= similarity).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The truly similar of the pairs. Sets are made of texts in these pairs alone and go when the pairs are decided."""
    spark = pairs.sparkSession
    path = scratch_path(spark, "pairs")
    with scratch_scope(spark):
        ends = pairs.select(F.col("a").alias("fid")).unionByName(pairs.select(F.col("b").alias("fid")))
        sets = store(shingle_sets(marked(texts, "fid", ends, "wanted").filter("wanted"), shingle))
        truly_similar(pairs, sets, similarity).write.parquet(path)
    return spark.read.schema("a bigint, b bigint").parquet(path)


def link_similar(fps: DataFrame, texts: DataFrame, shingle: int, similarity: float, recall: float) -> DataFrame:
    """``(a, b)`` of a graph on ``fid`` whose components are those of all pairs with an equal key in a table and, by their shingle sets, the similarity.

    ``fps`` is (fid, n, s0, s1, fp, few), ``texts`` (fid, raw). Tables are dealt in parts, and of each only what meets is
    kept: few sets in a key must have two that are close in their sketch. Only pairs that may still join two components are verified:
    first of each key's texts with one of them, drawn anew each time, and last, where a key's texts are still of several
    components, of each text outside the largest with all of another component. Sizes and sketches rule out most of the
    pairs below the similarity beforehand; a pair at the limit has so many differing bits in its sketch, and four
    deviations more lose none in practice. Shingles that are in no other text that meets any can't be shared: a text with
    too many of them is left out, however large the crowd it stands in, and others bound what a pair may share.
    """
    near = most_differing(similarity, 64)
    tables, meet = key_tables(similarity, recall, fps.count()), None
    for at in range(0, len(tables), TABLES):
        dealt = dealt_keys(fps, similarity, tables[at : at + TABLES], at)
        apart = F.bit_count(F.bit_or("bits").bitwiseXOR(F.bit_and("bits")))
        shared = dealt.groupBy("key").agg(F.count("*").alias("rows"), apart.alias("apart"))
        shared = shared.filter((F.col("rows") > 2) | (F.col("rows") == 2) & (F.col("apart") <= near)).select("key", "rows")
        part = store(dealt.join(shared.hint("merge"), "key"))
        chance = part.filter(F.col("rows").between(3, CHANCE)).groupBy("key").agg(F.collect_list("bits").alias("all"))
        chance = chance.filter(~F.exists("all", lambda x: F.size(F.filter("all", lambda y: F.bit_count(x.bitwiseXOR(y)) <= near)) > 1))
        part = store(part.drop("bits").join(chance.select("key"), "key", "left_anti"))
        meet = part if meet is None else meet.unionByName(part)
        del dealt, shared, chance
        free_shuffles(fps.sparkSession)
    alone = unshared(marked(texts, "fid", meet.select("fid"), "wanted").filter("wanted"), shingle)
    points = fps.select("fid", "n", "s0", "s1").join(alone, "fid", "left").withColumn("m", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone")
    points = store(points.filter(F.col("m") >= similarity * F.col("n") - 1e-6))

    def labelled(edges: DataFrame | None) -> DataFrame:
        if edges is None:
            return meet.join(points.withColumn("c", F.col("fid")), "fid")
        # Of two sets in a key the first round has seen the only pair.
        return meet.filter("rows > 2").join(points.join(components(edges).withColumnRenamed("v", "fid"), "fid", "left").withColumn("c", F.coalesce("c", "fid")), "fid")

    def proposed(rows: DataFrame, other: str, words: list[str], most: int) -> DataFrame:
        bits = sum(F.bit_count(F.col(s).bitwiseXOR(F.col(f"{other}.{s}"))) for s in words)
        sizes = F.least("n", f"{other}.n") >= similarity * F.greatest("n", f"{other}.n")
        close = (bits <= most) | (F.least("n", f"{other}.n") <= FEW)
        enough = F.least("m", f"{other}.m") * (1 + similarity) >= similarity * (F.col("n") + F.col(f"{other}.n")) - 1e-6
        rows = rows.filter((F.col("c") != F.col(f"{other}.c")) & sizes & close & enough)
        return rows.select(F.least("fid", f"{other}.fid").alias("a"), F.greatest("fid", f"{other}.fid").alias("b")).distinct()

    point = F.struct("fid", "n", "m", "s0", "s1", "c")
    edges, tested = None, None
    for turn in range(STARS + 1):
        rows = labelled(edges)
        if turn < STARS:
            drawn = rows.groupBy("key").agg(
                F.min_by(point, F.xxhash64("fid", F.lit(turn))).alias("o"), F.min("c").alias("low"), F.max("c").alias("high")
            ).filter("low < high").select("key", "o")
            pairs = proposed(rows.join(drawn, "key"), "o", ["s0", "s1"], most_differing(similarity, SKETCH))
        else:
            counts = rows.groupBy("key", "c").agg(F.count("*").alias("rows"))
            mixed = counts.groupBy("key").agg(F.max_by("c", F.struct("rows", "c")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
            # Here whole fingerprints are compared, as of a crowd's texts most pairs are just below the similarity.
            whole = [f"f{i}" for i in range(WIDE // 64)]
            wide = fps.select("fid", *[F.col("fp")[i].alias(f) for i, f in enumerate(whole)])
            rows = store(rows.join(mixed.select("key", "top"), "key").join(wide, "fid"))
            others = rows.filter("c <> top").select("key", F.struct("fid", "n", "m", "c", *whole).alias("o"))
            # Of two texts outside the largest component each meets the other; one of the two pairs will do.
            met = rows.join(others, "key").filter("c = top or fid < o.fid")
            pairs = proposed(met, "o", whole, most_differing(similarity, WIDE))
        pairs = store(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = verified(pairs, texts, shingle, similarity)
        tested = pairs if tested is None else tested.unionByName(pairs)
        edges = found if edges is None else edges.unionByName(found)
    return edges


def close_groups(docs: DataFrame, id_col: str = "doc_id", shingle: int = 3, radius: int = 3, text: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` per document: documents linked by chains of fingerprints within ``radius`` bits.

    Texts without words, null ones included, have the fingerprint zero and are linked like any other. A group's number
    is its smallest identifier that is not null. Repeated rows stay, with equal results.
    """
    rows = with_fingerprints(docs, [id_col], shingle, text=text)
    rows = store(rows)
    rows = rows.withColumn("fp", signed_long("_fp"))
    reps = store(rows.groupBy("fp").agg(F.min(id_col).alias("rep")))
    linked = components(link_close(reps, radius)).select(F.col("v").alias("fp"), "c")
    named = store(reps.join(linked, "fp", "left").withColumn("c", F.coalesce("c", "fp")))
    ids = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    return rows.select(id_col, "fp").join(named.join(ids, "c").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def signed_long(fp: str):
    """Eight little-endian bytes as a long: four 16-bit pieces, so that no step overflows."""
    text = F.hex(fp)
    value = F.lit(0).cast("long")
    for i in range(8):
        value = value.bitwiseOR(F.shiftleft(F.conv(F.substring(text, 2 * i + 1, 2), 16, 10).cast("long"), 8 * i))
    return value


def marked(rows: DataFrame, id_col: str, chosen: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: whether the row's number, of at least zero, is among those of ``chosen``.

    The numbers travel as bits, 32,768 to a row, so texts need not be shuffled to meet them.
    """
    number = F.col(id_col) + 1
    bits = store(chosen.groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")))
    at = f"bitmap_bit_position(`{id_col}` + 1)"
    byte = f"cast(conv(hex(substring(_bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(number)).join(bits, "_bucket", "left")
    return joined.withColumn(name, F.expr(f"coalesce((shiftright({byte}, cast({at} % 8 as int)) & 1) = 1, false)")).drop("_bucket", "_bits")


def numbered(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``_uid``, a number of the row that stays the same when the frame is read again.

    Rows read from Parquet files are numbered by file and place, so nothing is stored for it; one row a file passes the
    driver. Frames of other rows, or with rows of a file repeated, are stored with their numbers.
    """
    spark, chosen = docs.sparkSession, [F.col(f"`{c}`") for c in columns]
    try:
        place = docs.metadataColumn("_metadata")
        rows = docs.select(*chosen, place.getField("file_path").alias("_file"), place.getField("row_index").alias("_row"))
    except AnalysisException:
        return store(docs.select(*chosen).withColumn("_uid", F.monotonically_increasing_id()))
    files = rows.groupBy("_file").agg((F.max("_row") + 1).alias("end"), F.count("*").alias("rows")).orderBy("_file").collect()
    starts = accumulate((r["end"] for r in files), initial=0)
    starts = spark.createDataFrame([(r["_file"], s) for r, s in zip(files, starts)], "_file string, _start bigint")
    rows = rows.join(F.broadcast(starts), "_file").withColumn("_uid", F.col("_start") + F.col("_row"))
    bits = rows.groupBy(F.bitmap_bucket_number(F.col("_uid") + 1).alias("bucket")).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_uid") + 1))).alias("n"))
    if (bits.agg(F.sum("n")).first()[0] or 0) < sum(r["rows"] for r in files):
        return store(docs.select(*chosen).withColumn("_uid", F.monotonically_increasing_id()))
    return rows.select(*chosen, "_uid")


def similar_groups(docs: DataFrame, keep: list[str], id_col: str = "doc_id", shingle: int = 5, similarity: float = 0.8, recall: float = 0.99, text: str = "text") -> DataFrame:
    """``keep``, ``_uid`` and ``first``: whether a row stays as the one of its group of texts of the similarity or more.

    Texts are linked only if their sets of shingles, compared exactly, have the similarity; of pairs at exactly the
    similarity the share ``recall`` is found, of more similar ones more. Of equal identifiers or rows in a group one row
    stays. Texts without words form one group. Of what is stored on the way only the numbers of rows that stay are left.
    """
    spark = docs.sparkSession
    rows = numbered(docs, [*keep, *(c for c in dict.fromkeys([id_col, text]) if c not in keep)])
    path = scratch_path(spark, "stay")
    with scratch_scope(spark):
        signed = with_signatures(rows, ["_uid", id_col], shingle, similarity, text)
        best = F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("_uid"))).alias("best")
        parts = [F.first(f"_{c}").alias(c) for c in ("n", "s0", "s1", "fp", "few")]
        fps = store(signed.groupBy("_set").agg(best, *parts).withColumn("fid", F.col("best._uid")).drop("_set"))
        texts = rows.select(F.col("_uid").alias("fid"), text_bytes(text).alias("raw"))
        linked = components(link_similar(fps, texts, shingle, similarity, recall)).select(F.col("v").alias("fid"), "c")
        firsts = fps.select("fid", "best").join(linked, "fid", "left").groupBy(F.coalesce("c", "fid").alias("c")).agg(F.min("best").alias("best"))
        firsts.select(F.col("best._uid").alias("_uid")).write.parquet(path)
        del signed, fps, texts, linked, firsts
    stay = spark.read.schema("_uid bigint").parquet(path)
    return marked(rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, id_col])], "_uid"), "_uid", stay, "first")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = close_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash": op2_simhash}
