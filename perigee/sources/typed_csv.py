"""CSV scan whose column types follow from all values of all files, not from a sample.

Types form a lattice: long below double, everything below text; dates and timestamps in one column are text. Every value is placed once, the
places are counted per column in one aggregation over all lines, and a column's type is the least one that holds all of
its values. A late value in a column that is nearly empty therefore counts as much as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a value must look like, in the order in which it is tried, and the type it must then convert to.
SHAPES = (
    ("boolean", r"^(?i)(true|false)$"),
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(nan|inf|infinity)$"),
    ("date", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"),
)
# Types from the narrowest up, with the places whose values each of them holds.
HOLDS = (
    ("boolean", ("boolean",)), ("bigint", ("bigint",)), ("double", ("bigint", "double")), ("date", ("date",)),
    ("timestamp", ("timestamp",)),
)


def _typed(value: Column, name: str) -> Column:
    # Timestamps carry no zone in such files.
    return value.try_cast("timestamp_ntz" if name == "timestamp" else name)


def place(value: Column) -> Column:
    """The narrowest type of a value; null for a missing one."""
    found: Column = F.lit("string")
    for name, shape in reversed(SHAPES):
        found = F.when(value.rlike(shape) & _typed(value, name).isNotNull(), F.lit(name)).otherwise(found)
    return F.when(value.isNotNull() & (value != ""), found)


def infer_types(raw: DataFrame) -> dict[str, str]:
    """Type per text column: the least that holds all values; text for a column without any. One pass, one row of counts."""
    values = {c: F.trim(F.col(f"`{c}`")) for c in raw.columns}
    placed = raw.select(*[place(v).alias(f"_{i}") for i, v in enumerate(values.values())])
    counts = placed.agg(*[
        F.struct(F.count(f"_{i}").alias("all"), *[F.count_if(F.col(f"_{i}") == name).alias(name) for name, _ in SHAPES]).alias(f"_{i}")
        for i in range(len(values))
    ]).first()
    out = {}
    for i, c in enumerate(values):
        n = counts[i]
        fits = (name for name, holds in HOLDS if n["all"] and sum(n[h] for h in holds) == n["all"])
        out[c] = next(fits, "string")
    return out


def read_csv_typed(spark: SparkSession, path: str | list[str], header: bool = True, schema: dict[str, str] | None = None) -> DataFrame:
    """CSV files with every column under the type of all its values; ``schema`` gives the types and saves that scan.

    Fields are quoted by doubled quotes, records stay on one line, and files must share a header. Missing values are
    null, also in text columns. Numbers too large for a long make their column double.
    """
    raw = spark.read.option("maxCharsPerColumn", -1).option("escape", '"').option("header", header).option("enforceSchema", False).csv(path)
    types = schema or infer_types(raw)
    return raw.select(*[
        F.col(f"`{c}`") if types[c] == "string" else _typed(F.trim(F.col(f"`{c}`")), types[c]).alias(c) for c in raw.columns
    ])


def type_table(spark: SparkSession, types: dict[str, str]) -> DataFrame:
    """(column, type), one row a column."""
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("type", T.StringType())])
    return spark.createDataFrame(list(types.items()), schema)
