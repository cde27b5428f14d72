"""Removal of word sequences that occur more than once, found by recompression.

Texts become symbols by rounds that name runs of equal tokens, then pairs of neighbours. A name is a hash of what it
stands for and whether neighbours pair depends only on their names, so equal word sequences get equal symbols, and equal
symbol borders, except within CONTEXT words of their ends. Every window of words takes the border inside it whose
symbols hash lowest; equal windows take the same one. Rows of these borders are few, and borders whose surroundings are
found once in the whole corpus are dropped after counting hashes alone. For the others, a border whose whole reach (all
windows that take it) occurs twice proves all these windows repeated; only where reaches differ, at the ends of repeated
passages, are single windows compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, mix64, raw_texts, store, table, text_bytes, with_text

WINDOW = 35
# A border and the names of its two symbols are determined by this many words on either side.
CONTEXT = 5
# Words named at once; longer texts are named in pieces that share a window's words.
PIECE = 200_000
POSITION_BITS = 28
# Words of 64 bits in the filters that tell which hashes were found more than once.
FILTER_WORDS = 1 << 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, 1 << 18)
        base = int(BASES[which])
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[which] = (out[0], out[1])
    return _POWERS[which]


class SpanHash:
    """Hashes of spans of a sequence of words by sums of powers."""

    def __init__(self, words: np.ndarray, which: int):
        up, self.down = powers(which, len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix64(words + BASES[which]) * up[: len(words)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


def borders(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each position the hash of the symbols that meet there, NONE inside symbols. ``first`` marks starts of texts.

    Runs of three or more equal words have one name and don't pair; every position inside them counts as a border.
    """
    n = len(words)
    same = np.zeros(n, bool)
    same[1:] = (words[1:] == words[:-1]) & ~first[1:]
    at = np.flatnonzero(~same)
    length = np.diff(np.append(at, n))
    name = mix64(words[at] + np.minimum(length, 3).astype(np.uint64) * BASES[0])
    long, opens = length >= 3, first[at]
    for salt in (1, 2):
        side = mix64(name + np.uint64(salt)) >> np.uint64(63)
        pair = np.zeros(len(name), bool)
        pair[:-1] = (side[:-1] == 0) & (side[1:] == 1) & ~long[:-1] & ~long[1:] & ~opens[1:]
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        if salt == 2:
            break
        joined = name.copy()
        heads = np.flatnonzero(pair)
        joined[heads] = mix64(name[heads] * BASES[1] + mix64(name[heads + 1]))
        keep = ~second
        name, long, opens, at = joined[keep], long[keep], opens[keep], at[keep]
    out = np.full(n, NONE)
    left = np.empty_like(name)
    left[0], left[1:] = 0, name[:-1]
    out[at[~second]] = mix64(left * BASES[0] + name)[~second]
    inside = same.copy()
    inside[1:] &= same[:-1] | np.append(same[2:], False)
    return np.where(inside, mix64(words), out)


def anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(border, lowest start, highest start)``: the borders that windows take, with the range of these windows' starts."""
    n = len(words)
    if n < window:
        return (np.empty(0, np.int64),) * 3
    mask = np.uint64((1 << POSITION_BITS) - 1)
    value = borders(words, first)
    value = np.where(value == NONE, NONE, (value & ~mask) | np.arange(n, dtype=np.uint64))
    width = window - 2 * CONTEXT + 1
    low, reach = value[CONTEXT : n - CONTEXT + 1], 1
    while 2 * reach <= width:
        low, reach = np.minimum(low[:-reach], low[reach:]), 2 * reach
    low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])[: n - window + 1]
    text = np.cumsum(first)
    start = np.flatnonzero(text[: n - window + 1] == text[window - 1 :])
    if not len(start):
        return (np.empty(0, np.int64),) * 3
    taken = (low[start] & mask).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (taken[1:] != taken[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(new)
    return taken[heads], start[heads], start[np.append(heads[1:], len(start)) - 1]


def word_hashes(raw: bytes) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in raw.split()]), np.uint64)


def pieces(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(words, first, text, offset)`` of groups of texts or parts of long ones; parts overlap by a window less one."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def group():
        words = np.concatenate([h[2] for h in held])
        lengths = np.array([len(h[2]) for h in held])
        first = np.zeros(len(words), bool)
        first[np.cumsum(lengths) - lengths] = True
        return words, first, np.array([h[0] for h in held]), np.array([h[1] for h in held])

    for i, raw in enumerate(texts):
        if len(raw) < 2 * window - 1:
            continue
        words = word_hashes(raw)
        for at in range(0, max(len(words) - window + 1, 0), PIECE):
            part = words[at : at + PIECE + window - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= PIECE:
                yield group()
                held, size = [], 0
    if held:
        yield group()


def found_anchors(texts: list[bytes], window: int, details: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[dict[str, np.ndarray | list]]:
    """Columns of the anchors of some texts: key and reach, or with ``details`` (filters) the text, range and windows too."""
    for words, first, text, offset in pieces(texts, window):
        border, low, high = anchors(words, first, window)
        if not len(border):
            continue
        near, whole = SpanHash(words, 0), SpanHash(words, 1)
        key = near(border - CONTEXT, border + CONTEXT)
        reach = whole(low, high + window) + ((border - low) * 4096 + (high - low)).astype(np.uint64)
        if details is None:
            yield {"key": key.view(np.int64), "reach": mix64(reach).view(np.int64)}
            continue
        shared = in_filter(details[0], key)
        key, reach, low, high = key[shared], reach[shared], low[shared], high[shared]
        starts = np.flatnonzero(first)
        part = np.searchsorted(starts, low, "right") - 1
        differing = in_filter(details[1], key)
        windows = [
            whole(s := np.arange(a, b + 1), s + window).tobytes() if d else None for a, b, d in zip(low, high, differing)
        ]
        shift = offset[part] - starts[part]
        yield {"key": key.view(np.int64), "reach": mix64(reach).view(np.int64), "text": text[part], "low": low + shift, "high": high + shift, "windows": windows}


def filter_spots(key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in (0, 26):
        spot = (key >> np.uint64(at)) & np.uint64(64 * FILTER_WORDS - 1)
        yield spot >> np.uint64(6), spot & np.uint64(63)


def in_filter(words: np.ndarray, key: np.ndarray) -> np.ndarray:
    hit = np.ones(len(key), bool)
    for word, bit in filter_spots(key):
        hit &= (words[word] >> bit) & np.uint64(1) == 1
    return hit


def build_filter(keys: DataFrame) -> np.ndarray:
    """A bit filter of fixed size over the ``key`` column: has all its keys and, by chance, a few others."""
    spots = F.explode(F.array(*[
        F.shiftrightunsigned("key", at).bitwiseAND(F.lit(64 * FILTER_WORDS - 1)) for at in (0, 26)
    ])).alias("spot")
    one = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    rows = keys.select(spots).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def identity(text: str) -> list[Column]:
    """Two hashes that stand for a whole text; equal texts share what is found in them."""
    raw = text_bytes(text)
    return [F.xxhash64(raw).alias("_t"), (F.crc32(raw) * F.lit(1 << 31) + F.length(raw)).alias("_u")]


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(_t, _u, low, high)``: in the texts of that identity, windows starting at words low to high occur elsewhere too."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for found in found_anchors(b.column(0).to_pylist(), window):
                yield batch(**found)

    hashes = arrow_map(docs.select(text_bytes(text).alias("raw")), count, "key bigint, reach bigint")
    by_key = hashes.groupBy("key").agg(F.count("*").alias("n"), F.min("reach").alias("a"), F.max("reach").alias("b")).filter("n > 1")
    by_key = store(by_key.select("key", (F.col("a") != F.col("b")).alias("differing")))
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast((build_filter(by_key), build_filter(by_key.filter("differing"))))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, u = (b.column(i).to_numpy() for i in (1, 2))
            for found in found_anchors(b.column(0).to_pylist(), window, filters.value):
                at = found.pop("text")
                yield batch(**{k: v for k, v in found.items() if k != "windows"}, _t=t[at], _u=u[at], windows=pa.array(found["windows"], pa.binary()))

    schema = "key bigint, reach bigint, low bigint, high bigint, _t bigint, _u bigint, windows binary"
    rows = arrow_map(docs.select(text_bytes(text).alias("raw"), *identity(text)), describe, schema)
    # Equal texts are one row with a count from here on.
    rows = store(rows.groupBy("key", "reach", "_t", "_u", "low", "high").agg(F.count("*").alias("copies"), F.first("windows").alias("windows")))
    reaches = store(rows.groupBy("key", "reach").agg(F.sum("copies").alias("n")).filter("n > 1"))
    whole = rows.join(reaches, ["key", "reach"]).select("_t", "_u", "low", "high")

    # Where reaches differ: windows of those found once, and one row for each reach found more often.
    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [np.frombuffer(w, np.int64) for w in b.column(5).to_pylist()]
            sizes = np.array([len(h) for h in hashes], np.int64)
            index = np.repeat(np.arange(len(sizes)), sizes)
            step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            take = {c: b.column(i).to_numpy(zero_copy_only=False)[index] for i, c in enumerate(("key", "n", "_t", "_u", "low"))}
            yield batch(key=take["key"], hash=np.concatenate(hashes or [np.empty(0, np.int64)]), n=take["n"], _t=take["_t"], _u=take["_u"], low=take["low"] + step)

    some = rows.filter("windows is not null")
    once = some.join(reaches, ["key", "reach"], "left_anti").select("key", F.lit(1).cast("bigint").alias("n"), "_t", "_u", "low", "windows")
    often = some.join(reaches.select("key", "reach"), ["key", "reach"], "left_semi").groupBy("key", "reach").agg(F.min(F.struct("_t", "_u", "low", "windows")).alias("x"))
    often = often.select("key", F.lit(2).cast("bigint").alias("n"), "x._t", "x._u", "x.low", "x.windows")
    parts = store(arrow_map(once.unionByName(often), single, "key bigint, hash bigint, n bigint, _t bigint, _u bigint, low bigint"))
    twice = store(parts.groupBy("key", "hash").agg(F.sum("n").alias("total")).filter("total > 1").select("key", "hash"))
    edge = parts.filter("n = 1").join(twice, ["key", "hash"]).select("_t", "_u", "low", F.col("low").alias("high"))
    return whole.unionByName(edge).distinct()


def cut_repeats(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """``keep`` with n_words, n_removed and ``kept``, the words left, joined by one space, as bytes.

    A word goes if a window of words over it occurs anywhere else, in the same text or another; windows are judged on
    the input. Texts shorter than a window, empty and null ones lose nothing. Repeated rows count as repeats. Spans are
    gathered by text, at most one per word of it, and joined to texts; of many equal texts, Spark splits the rows.
    """
    spans = repeated_spans(docs, text, window).groupBy("_t", "_u").agg(F.collect_list(F.struct("low", "high")).alias("_spans"))
    spans = store(spans.select("_t", "_u", F.col("_spans.low").alias("_low"), F.col("_spans.high").alias("_high")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, left = [], [], []
            lows, highs = b.columns[-2:]
            for raw, low, high in zip(raw_texts(b, at), lows, highs):
                words = raw.split()
                n.append(len(words))
                if not low.is_valid:
                    gone.append(0)
                    left.append(b" ".join(words))
                    continue
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, low.values.to_numpy(), 1)
                np.add.at(cover, high.values.to_numpy() + window, -1)
                out = np.cumsum(cover[:-1]) > 0
                gone.append(int(out.sum()))
                left.append(b" ".join([words[i] for i in np.flatnonzero(~out)]))
            yield batch(**{c: b.column(i) for i, c in enumerate(keep)}, n_words=np.array(n, np.int64), n_removed=np.array(gone, np.int64), kept=pa.array(left, pa.binary()))

    # Texts that surely lose nothing are never shuffled: a filter tells them from those that may have spans.
    known = docs.sparkSession.sparkContext.broadcast(build_filter(spans.select(F.col("_t").alias("key"))))

    def hits(b: pa.RecordBatch) -> np.ndarray:
        return in_filter(known.value, b.column("_t").to_numpy().view(np.uint64))

    def spare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(~hits(b)))
            n, left = [], []
            for raw in raw_texts(b, at):
                words = raw.split()
                n.append(len(words))
                left.append(b" ".join(words))
            yield batch(
                **{c: b.column(i) for i, c in enumerate(keep)}, n_words=np.array(n, np.int64), n_removed=np.zeros(len(n), np.int64),
                kept=pa.array(left, pa.binary()),
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(hits(b)))

    chosen, at = with_text(docs.withColumns(dict(zip(("_t", "_u"), identity(text)))), [*keep, "_t", "_u"], text)
    given = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    fields = ", ".join([*given[: len(keep)], "n_words bigint, n_removed bigint, kept binary"])
    met = arrow_map(chosen, meet, ", ".join(given)).join(spans, ["_t", "_u"], "left").select(*chosen.columns, "_low", "_high")
    return arrow_map(chosen, spare, fields).unionByName(arrow_map(met, cut, fields))


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op7_recompression": op7_recompression}
