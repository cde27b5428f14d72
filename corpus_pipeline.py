"""From raw documents to packed training sequences, in five stages over the operators of ``perigee.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``. Null and empty texts, repeated rows and empty
tables pass through with defined results: each function says which. Columns other than those of ``documents`` are
dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.mixing import mix
from perigee.llm.packing import pack, word_tokenizer
from perigee.llm.repeats import cut_repeats
from perigee.llm.rules import apply_rules
from perigee.llm.simhash import similar_groups
from perigee.session import drop_scratch, scratch_path, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of text and host. Null and empty texts go; repeated rows share their fate."""
    return apply_rules(docs, COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 or more of their runs of five words, the one with the smallest
    doc_id; of repeated rows one stays. Texts without words are one group."""
    return similar_groups(docs, COLUMNS).filter("first").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of 35 words or more that occur more than once.

    A text that loses words is what is left, joined by single spaces, with its number of characters; others stay as
    they are. A text that loses all words stays as an empty one.
    """
    cut = cut_repeats(docs, COLUMNS).withColumn("left", F.col("kept").cast("string"))
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id", F.when(changed, F.col("left")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length("left").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as the mix of sources takes copies of it. Texts without words are not mixed in."""
    mixed = mix(docs, COLUMNS).filter("size > 0")
    return mixed.select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 4096 tokens; copies are packed each for itself."""
    return pack(docs, ["doc_id"], word_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]
# Fingerprints, shares of similarity and token counts have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stores on its way goes when its result is written, and its input, if a stage wrote it, too."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            drop_scratch(spark, last)
        last = path
    return docs
