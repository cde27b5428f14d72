"""Helpers shared by the operators: text as bytes, stored intermediate tables, Arrow maps, connected components.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. These are the
separators of ``bytes.split()``, and they never occur inside a UTF-8 character, so texts travel as binary columns.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.session import cut_lineage

# The same words for Spark's regular expressions; fixed by the contract of the queries.
WORD = r"[^\x20\x09-\x0D]+"
# Rows and bytes of text that reach Python at once; an executor and its Python workers each hold a few such batches.
BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20
# What a Python worker keeps from task to task, by operator.
KEPT: dict[str, dict] = {}

store = cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def with_text(docs: DataFrame, keep: Sequence[str], text: str) -> tuple[DataFrame, int]:
    """``keep``, and the text behind them unless it is one of them, so that no text travels twice; and the text's place."""
    columns = [F.col(f"`{c}`") for c in keep]
    if text in keep and docs.schema[text].dataType.simpleString() in ("string", "binary"):
        return docs.select(*columns), list(keep).index(text)
    return docs.select(*columns, text_bytes(text).alias("__text")), len(columns)


def raw_texts(b: pa.RecordBatch, at: int) -> list[bytes]:
    """A text column of a batch as UTF-8 bytes, null as empty."""
    return [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Returns memory that the allocators of a Python worker hold unused."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def one_task(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, kept in KEPT.items():
        if name != keeps:
            kept.clear()
    yield from fn(batches)
    give_back()


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: str = "") -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes, so that long texts don't add up.

    Workers serve the tasks of all operators in turn: a task drops what others than ``keeps`` left in KEPT, and gives
    unused memory back at its end.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(partial(one_task, fn, keeps), schema)


def batch(**columns) -> pa.RecordBatch:
    """A record batch of the given numpy arrays, lists or Arrow arrays."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()], names=list(columns)
    )


def n_buckets(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit numbers; every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame) -> DataFrame:
    """``(v, c)`` for the vertices of ``(a, b)`` edges: c is the smallest vertex of v's connected component.

    Alternating star contractions: each round links every vertex's larger neighbours, then its smaller ones, to the
    smallest of them. Every round is stored, so a lost executor costs one round at most. All work is by vertex and
    combined before the shuffle; a hub's edges are only ever reduced to a minimum and joined, never gathered.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()

    current = store(pairs(edges))
    total = current.count()
    seen = (-1, None)
    while total:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of each vertex now hang on its minimum.
        large = store(pairs(current.join(low, "a").select(F.col("b"), F.col("m").alias("a"))))
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.when(F.col("a") != F.col("m"), F.col("a")).otherwise(F.col("b")).alias("b"))
        current = store(pairs(small.unionByName(low.select(F.col("m").alias("a"), "b"))))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    leaf = current.select(F.col("b").alias("v"), F.col("a").alias("c"))
    return leaf.unionByName(leaf.select(F.col("c").alias("v"), "c").distinct())


def columns_of(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])
