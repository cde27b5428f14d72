"""Readers, schema alignment, writers and the row-count contract."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.spec import CLASS_SEED_SCHEMA, FeatureSpec

SEEDS = Path(__file__).resolve().parent.parent / "seeds"
CORRUPT = "_corrupt"


def _csv(spark: SparkSession):
    return spark.read.option("maxCharsPerColumn", -1).option("escape", '"')


def read_csv_lenient(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, mixed_headers: bool = False
) -> DataFrame:
    """CSV scan with a declared schema. Bad values become null and the whole line is kept in ``_corrupt``.

    Files stay splittable: a record never spans lines, so a stray quote cannot swallow its neighbours. Columns are
    taken by header name in any order and case. All files must have the header of the first, or the scan fails; with
    ``mixed_headers`` one more scan of lines groups the files by header, and each group is read by its own.
    """
    if not header:
        return _lenient(_csv(spark).schema(_with_corrupt(schema)), path)
    if not mixed_headers:
        return _by_name(spark, path, _csv(spark).option("header", True).csv(path).columns, schema)
    # The first line of every file, from its first block.
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("line")).collect()  # one row per file
    groups: dict[str, list[str]] = {}
    for row in sorted(first, key=lambda r: r["file"]):
        groups.setdefault(row["line"], []).append(row["file"])
    parts = [_by_name(spark, files, _csv(spark).option("header", True).csv(files[:1]).columns, schema) for files in groups.values()]
    if not parts:
        return spark.createDataFrame([], _with_corrupt(schema))
    return reduce(DataFrame.unionByName, parts)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def _lenient(reader, path) -> DataFrame:
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def _by_name(spark: SparkSession, path, names: list[str], schema: T.StructType) -> DataFrame:
    """Files with the header ``names``, every column read under its declared type; a file with another header fails."""
    declared = {f.name.lower(): f for f in schema.fields}
    ordered = T.StructType([
        T.StructField(n, declared[n.lower()].dataType if n.lower() in declared else T.StringType()) for n in names
    ])
    raw = _lenient(_csv(spark).schema(_with_corrupt(ordered)).option("header", True).option("enforceSchema", False), path)
    present = {n.lower(): n for n in names}
    return raw.select(
        *[
            F.col(f"`{present[f.name.lower()]}`").alias(f.name) if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        CORRUPT,
    )


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = {c.lower() for c in df.columns}
    return [f.name for f in schema.fields if f.name.lower() not in present]


def align_to_schema(df: DataFrame, schema: T.StructType, overrides: dict[str, str] | None = None) -> DataFrame:
    """Select the schema's columns by case-folded name, ``try_cast`` to its types; missing columns become null."""
    overrides = {k.lower(): v for k, v in (overrides or {}).items()}
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        key = field.name.lower()
        target = overrides.get(key, field.dataType.simpleString())
        source = F.col(f"`{present[key]}`") if key in present else F.lit(None)
        out.append(source.try_cast(target).alias(field.name))
    return df.select(*out)


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def class_seed(spark: SparkSession) -> DataFrame:
    """The class-code seed. Its file ships with the library, so the rows are parallelised from the driver."""
    lines = [line for line in (SEEDS / "body_classes.csv").read_text("utf-8").splitlines() if not line.startswith("#")]
    rows = [line.split(",", 2) for line in lines[1:]]
    return spark.createDataFrame([(int(code), abbr, name) for code, abbr, name in rows], CLASS_SEED_SCHEMA)


def load_mart(spark: SparkSession, path: str, spec: FeatureSpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Column-pruned mart read: key, 0/1 target, features and any extra label columns."""
    return spark.read.parquet(path).select(
        F.col(spec.id), F.col(spec.target).cast("int").alias(spec.target), *spec.features, *extra
    )


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a materialised table; returns the stored frame."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def row_count_check(df: DataFrame, expected: int, name: str = "row_count") -> DataFrame:
    """One row ``(check, expected, actual, ok)``."""
    return df.agg(F.count("*").alias("actual")).select(
        F.lit(name).alias("check"),
        F.lit(expected).cast("bigint").alias("expected"),
        "actual",
        (F.col("actual") == expected).alias("ok"),
    )
