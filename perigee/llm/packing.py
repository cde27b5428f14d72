"""Packing token sequences by exact complements.

Lengths are small whole numbers, so the packing is decided on the table of how many pieces have each length, which is no
longer than the capacity. From the longest length down, the gap beside a piece is looked up among single lengths, sums of
pairs and sums of triples that are available, and as many equal combinations as there are pieces for are consumed at
once. What fits nowhere exactly is placed by best fit, again many equal pieces at a time. Pieces then find their place by
their length and a number within it.
"""

from __future__ import annotations

import os
import struct
import zlib
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perigee.llm.common import KEPT, arrow_map, batch, n_buckets, store, table, text_bytes

CAPACITY = 4096
END = 1
# Words whose tokens a worker remembers: up to twice as many.
WORD_CACHE = 120_000
# How the tokenizer's special tokens begin.
SPECIAL = b"<|"
ASCII_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
# Letters below have one form and one lower case; they are Latin.
LATIN_END = "\u0250"
# How byte-level vocabularies write bytes as characters: printable ones as themselves, the others in order from 256.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
BYTE_LETTERS = "".join(_OTHERS.get(b, chr(b)) for b in range(256))
# Pieces of one length and bucket that one task numbers.
BUCKET = 100_000


class Cache(dict):
    """Values made on demand by a function. At a number of entries it starts anew; entries of the time before are kept
    aside once, so those still in use come back without being made again."""

    def __init__(self, make: Callable[[bytes], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokens:
    """Token bytes of words. The tokenizer drops white space and never joins across it, so words are encoded one by one.

    It also splits letters from other characters. A word of Latin letters with ASCII punctuation behind it is its letters'
    tokens, straight from the merges, and the punctuation's; all other words go through the whole tokenizer.
    """

    _shared: dict[str, WordTokens] = KEPT.setdefault("packing", {})

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.words = Cache(self._word, WORD_CACHE)

    @classmethod
    def of(cls, path: str) -> WordTokens:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes: ASCII letters alone
            return self._letters(word.lower().decode())
        stem = word.rstrip(ASCII_PUNCTUATION)
        if stem.isalpha():
            return self.words[stem] + self.words[word[len(stem) :]]
        low = stem.decode("utf-8", "replace").lower()
        # Some capital's lower case is a letter and a mark, which is no letter.
        if not low.isalpha() or max(low) >= LATIN_END:
            return self._whole(word.decode("utf-8", "replace"))
        if len(stem) == len(word):
            return self._letters(charmap_decode(low.encode(), "strict", BYTE_LETTERS)[0])
        return self.words[stem] + self.words[word[len(stem) :]]

    def _letters(self, letters: str) -> bytes:
        ids = [t.id for t in self.merges.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, raw: bytes) -> bytes:
        """The text's token ids as little-endian unsigned 32-bit numbers.

        The tokenizer takes A-Z as a-z, so texts are looked up in lower case and fewer words are new. Only its special
        tokens are written in one case.
        """
        if SPECIAL not in raw:
            raw = raw.lower()
        return b"".join(map(self.words.__getitem__, raw.split()))


def token_pieces(docs: DataFrame, keep: list[str], tokenizer: str, text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``keep`` with piece, start, length and ids_crc32 of every piece of every text, each text ending in ``end``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.of(tokenizer)
        tail = np.array([end], "<u4").tobytes()
        for b in batches:
            row, piece, length, crc = [], [], [], []
            for i, raw in enumerate(b.column(b.num_columns - 1).to_pylist()):
                ids = memoryview(tokens.encode(raw) + tail)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            at = pa.array(row, pa.int64())
            piece = np.array(piece, np.int32)
            yield batch(
                **{c: b.column(i).take(at) for i, c in enumerate(keep)}, piece=piece, start=piece.astype(np.int64) * capacity,
                length=np.array(length, np.int64), ids_crc32=np.array(crc, np.int64),
            )

    chosen = docs.select(*[F.col(c) for c in keep], text_bytes(text).alias("__text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]), "piece int, start bigint, length bigint, ids_crc32 bigint"])
    return arrow_map(chosen, run, fields, keeps="packing")


class Complements:
    """Counts of available lengths with an index of their pair sums, kept up to date as lengths run out."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.capacity = len(counts) - 1
        have = (counts > 0).astype(np.int64)
        # Ordered pairs of available lengths by their sum.
        self.pairs = np.rint(np.fft.irfft(np.fft.rfft(have, 2 * len(have)) ** 2, 2 * len(have))).astype(np.int64)[: len(have)]

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in set(lengths):
            self.counts[x] -= times * lengths.count(x)
            if not self.counts[x]:
                rest = np.flatnonzero(self.counts[: self.capacity + 1 - x])
                self.pairs[rest + x] -= 2
                if 2 * x <= self.capacity:
                    self.pairs[2 * x] -= 1

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(int(self.counts[x]) // lengths.count(x) for x in set(lengths))

    def filling(self, longest: int) -> tuple[int, ...] | None:
        """A piece of the given length with one, two or three others that fill the capacity exactly, if they are there."""
        gap = self.capacity - longest
        if gap == 0:
            return (longest,)
        if self.times((longest, gap)):
            return longest, gap
        if (pair := self.pair(longest, gap)) is not None:
            return longest, *pair
        # Third lengths from the largest down whose rest some pair sums to.
        third = np.arange(gap - 2, 0, -1)
        third = third[(self.counts[third] > 0) & (self.pairs[gap - third] > 0)]
        for c in third.tolist():
            if 3 * c < gap:
                break
            if (pair := self.pair(longest, gap - c, c)) is not None:
                return longest, c, *pair
        return None

    def pair(self, longest: int, total: int, third: int | None = None) -> tuple[int, int] | None:
        if total < 2 or not self.pairs[total]:
            return None
        large = np.arange(total - 1, (total - 1) // 2, -1)
        for a in large[(self.counts[large] > 0) & (self.counts[total - large] > 0)].tolist():
            if self.times((longest, a, total - a, *(() if third is None else (third,)))):
                return a, total - a
        return None


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a sequence in order, how many such sequences)``, from the number of pieces by length."""
    table = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        table[length] = n
    left, plan = Complements(table), []
    for longest in range(capacity, 0, -1):
        while left.counts[longest] and (lengths := left.filling(longest)) is not None:
            n = left.times(lengths)
            left.take(lengths, n)
            plan.append((lengths, n))
    return plan + best_fit(left.counts)


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Pieces from the longest down, each into the open sequence with the smallest gap that holds it, equal ones at once."""
    capacity = len(counts) - 1
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    gaps = np.zeros(capacity + 1, bool)

    def put(lengths: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(lengths)
        open_by_gap[gap].append((lengths, n))
        gaps[gap] = True

    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            fit = np.flatnonzero(gaps[length:])
            if len(fit):
                gap = length + int(fit[0])
                lengths, m = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    gaps[gap] = False
                # As many of the length as fit: after the first, the same sequence has the smallest gap.
                each = gap // length
                if n >= each * m:
                    put(lengths + (length,) * each, m)
                    n -= each * m
                else:
                    full, rest = divmod(n, each)
                    if full:
                        put(lengths + (length,) * each, full)
                    if rest:
                        put(lengths + (length,) * rest, 1)
                    if m - full - bool(rest):
                        put(lengths, m - full - bool(rest))
                    n = 0
            else:
                put((), n if length * 2 > capacity else -(-n // (capacity // length)))
    return [(lengths, m) for groups in open_by_gap.values() for lengths, m in groups if lengths]


def plan_runs(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``(length, first number, sequence, offset)`` sorted by length and number: from that number on, pieces of the
    length go to one sequence after the other at the offset. A length has a few rows for each pattern it is part of."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += n
            offset += x
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def numbered(pieces: DataFrame, order: list[Column], total: int) -> DataFrame:
    """``number`` from 0 within a length, gapless. Buckets by hash keep any length's rows spread over tasks."""
    spread = pieces.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n_buckets(total, BUCKET))))
    inside = Window.partitionBy("length", "_b").orderBy(*order)
    counts = spread.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    running = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    before = counts.select("length", "_b", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    placed = spread.withColumn("_i", F.row_number().over(inside) - 1).join(before, ["length", "_b"])
    return placed.withColumn("number", F.col("_i") + F.col("_before")).drop("_b", "_i", "_before")


def pack(docs: DataFrame, keep: list[str], tokenizer: str, text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``keep`` with piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A null or empty text is the end token alone. Only texts longer than the capacity are cut. Repeated rows are packed
    each for itself. The plan, whose size depends on the capacity and not on the data, goes to all tasks.
    """
    pieces = store(token_pieces(docs, keep, tokenizer, text, capacity, end))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan_runs(packing_plan(counts, capacity))
    key = (runs[:, 0] << 44) + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            at = np.searchsorted(key, (length << 44) + number, "right") - 1
            columns = {c: b.column(c) for c in names}
            yield batch(**columns, sequence_id=runs[at, 2] + number - runs[at, 1], offset=runs[at, 3])

    order = [*[F.col(c) for c in keep], F.col("piece"), F.col("ids_crc32")]
    rows = numbered(pieces, order, sum(counts.values()))
    names = [*keep, "piece", "start", "length", "ids_crc32"]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields), "sequence_id bigint, offset bigint"])
    return arrow_map(rows.select(*names, "number"), place, fields)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), ["doc_id"], word_tokenizer())


QUERIES = {"op4_complement_packing": op4_complement_packing}
