"""Quality classifier: gradient-boosted trees on histograms of document statistics.

Statistics are computed for every whole text. Training takes a bounded sample of labelled documents, puts each statistic
into bins and grows trees level by level on histograms of gradients. The trees become a few arrays, through which all
trees of a batch of documents are walked at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, store, table, text_bytes
from perigee.llm.rules import text_stats

# Labelled documents used for training at most: those with the smallest hash of their identifier.
SAMPLE_ROWS = 40_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
L2 = 1.0
MIN_ROWS = 20
THRESHOLD = 0.3
PUNCTUATION = np.array([chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for b in range(256)])


def features(raw: bytes) -> list[float]:
    """Statistics of a text that say nothing of its source: sizes, shares of kinds of bytes and words, repetition."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = text_stats(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, words = max(len(raw), 1), max(n_words, 1)
    share = counts[counts > 0] / size
    parts = raw.split()
    common = Counter(parts)
    top = [n for _, n in common.most_common(3)] + [0, 0, 0]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.array([len(p) for p in parts] or [0])
    letters = counts[65:91].sum() + counts[97:123].sum()
    return [
        np.log1p(n_words), word_chars / words, lengths.std(), lengths.max(), n_symbols / words, n_dup_lines / max(len(lines), 1), n_repeat / words,
        np.log1p(n_repeat), counts[65:91].sum() / max(letters, 1), counts[48:58].sum() / size, counts[128:].sum() / size, counts[PUNCTUATION].sum() / words,
        counts[33] / words, counts[46] / words, counts[44] / words, counts[124] / words, counts[64] / words, counts[47] / words, counts[58] / words,
        counts[45] / words, counts[10] / words, counts[:9].sum() / size, -(share * np.log2(share)).sum(), len(common) / words,
        top[0] / words, (top[0] + top[1] + top[2]) / words, len(lines), n_words / max(len(lines), 1), len(zlib.compress(raw, 1)) / size,
        sum(n for w, n in common.items() if len(w) == 1) / words, sum(n for w, n in common.items() if w.isupper()) / words,
        sum(n for w, n in common.items() if w.isdigit()) / words, sum(n for w, n in common.items() if len(w) > 20) / words,
    ]


N_FEATURES = len(features(b""))


def document_features(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``features`` of every text; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([features(t) for t in b.column(b.num_columns - 1).to_pylist()], np.float32).reshape(-1, N_FEATURES)
            flat = pa.array(rows.ravel(), pa.float32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_FEATURES), flat)
            yield batch(**{c: b.column(i) for i, c in enumerate(keep)}, features=lists)

    chosen = docs.select(*[F.col(c) for c in keep], text_bytes(text).alias("__text"))
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]), "features array<float>"])
    return arrow_map(chosen, run, fields)


@dataclass
class Forest:
    """Complete trees of one depth: features and thresholds of inner nodes and values of leaves, row by row of trees."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        if not trees:
            return 1 / (1 + np.exp(-total))
        feature, threshold = self.feature.ravel(), self.threshold.ravel()
        offset = np.arange(trees) * inner
        for at in range(0, len(x), 2048):
            part = x[at : at + 2048]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), trees), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                spot = offset + node
                node = 2 * node + 1 + (part[rows, feature[spot]] > threshold[spot])
            total[at : at + 2048] += self.value[np.arange(trees), node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees on logistic loss. Of equal gains, the first feature and lowest bin is taken, so runs agree."""
    n, d = x.shape
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    rate = (y.sum() + 1) / (n + 2)
    base = float(np.log(rate / (1 - rate)))
    if not n or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1], method="lower")) for j in range(d)]
    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    edges = np.full((d, BINS), np.inf)
    for j, c in enumerate(cuts):
        edges[j, : len(c)] = c
    cell = bins + np.arange(d) * BINS
    margin = np.full(n, base)
    forest = Forest(np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves)), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            width, start = 2**level, 2**level - 1
            spot = ((node - start)[:, None] * (d * BINS) + cell).ravel()
            shape = (width, d, BINS)
            hist = [np.bincount(spot, np.repeat(v, d), width * d * BINS).reshape(shape) for v in (g, h)]
            count = np.bincount(spot, minlength=width * d * BINS).reshape(shape)
            gl, hl, cl = (np.cumsum(v, axis=2) for v in (*hist, count))
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(cl < MIN_ROWS) | (ct - cl < MIN_ROWS)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            top = gain.reshape(width, -1).max(axis=1)
            j, b = best // BINS, best % BINS
            use = top > 1e-9
            forest.feature[t, start : start + width] = np.where(use, j, 0)
            forest.threshold[t, start : start + width] = np.where(use, edges[j, b], np.inf)
            mine = node - start
            go = use[mine] & (bins[np.arange(n), j[mine]] > b[mine])
            node = 2 * node + 1 + go
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        forest.value[t] = -RATE * gs / (hs + L2)
        margin += forest.value[t][leaf]
    return forest


def held_out(id_col: str) -> Column:
    """Documents never learned from: the remainder by five of the identifier's CRC-32 is 0; those without identifier too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(rows: DataFrame, labels: DataFrame, id_col: str, label: str) -> Forest:
    """Trees from at most SAMPLE_ROWS labelled rows of ``(id, features)`` that are not held out.

    Several labels of one identifier count by their mean; null labels don't count. Without both labels, scores are
    the share of label 1, or one half without any.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg((F.avg(label) >= 0.5).cast("int").alias("_y"))
    sample = rows.join(known, id_col).select("features", "_y", F.xxhash64(id_col).alias("_h"), F.col(id_col).alias("_i"))
    got = sample.orderBy("_h", "_i", "features").limit(SAMPLE_ROWS).select("features", "_y").toArrow()
    x = got["features"].combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
    return grow(x, got["_y"].to_numpy().astype(np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", text: str = "text") -> DataFrame:
    """``(id, held_out, score)`` of every document; repeated rows score alike and empty texts have a score."""
    rows = store(document_features(docs, [id_col], text))
    forest = train(rows, labels, id_col, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("features").flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
            yield batch(**{id_col: b.column(0), "held_out": b.column(1)}, score=forest.score(x))

    kind = rows.schema[id_col].dataType.simpleString()
    return arrow_map(rows.select(id_col, held_out(id_col).alias("held_out"), "features"), run, f"`{id_col}` {kind}, held_out boolean, score double")


def op3_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op3_boosted_trees": op3_boosted_trees}
