"""Data-quality checks. Each check yields rows ``(check, target, failing_rows, observed, passed)``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``scan`` checks are aggregate columns and share one pass per table; others build their own frame."""

    name: str
    table: str
    target: str
    scan: Callable[[], tuple[Column, Column, Column]] | None = None
    build: Callable[[dict[str, DataFrame]], DataFrame] | None = None


def _failures(bad: Column) -> tuple[Column, Column, Column]:
    failing = F.count(F.when(bad, 1))
    return failing, failing.cast("double"), failing == 0


def not_null(table: str, col: str) -> Check:
    return Check("not_null", table, col, scan=lambda: _failures(F.col(col).isNull()))


def accepted_values(table: str, col: str, values: Sequence) -> Check:
    """Nulls are left to :func:`not_null`."""
    return Check("accepted_values", table, col, scan=lambda: _failures(F.col(col).isNotNull() & ~F.col(col).isin(list(values))))


def ratio_band(table: str, flag: str, low: float, high: float) -> Check:
    def scan():
        ratio = F.sum(F.when(F.col(flag), 1).otherwise(0)).cast("double") / F.count("*")
        inside = F.coalesce(ratio.between(low, high), F.lit(False))
        return F.when(inside, 0).otherwise(1).cast("bigint"), ratio, inside

    return Check("ratio_band", table, flag, scan=scan)


def row_count(table: str, expected: int) -> Check:
    def scan():
        n = F.count("*")
        return F.abs(n - F.lit(expected)).cast("bigint"), n.cast("double"), n == expected

    return Check("row_count", table, "*", scan=scan)


def contiguous_codes(table: str, col: str, size: int) -> Check:
    """Codes are exactly 0..size-1, each once."""
    def scan():
        good = (F.min(col) == 0) & (F.max(col) == size - 1) & (F.count_distinct(col) == size) & (F.count(col) == size)
        good = F.coalesce(good, F.lit(False))
        return F.when(good, 0).otherwise(1).cast("bigint"), F.count_distinct(col).cast("double"), good

    return Check("contiguous_codes", table, col, scan=scan)


def _one_row(check: str, target: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check"), F.lit(target).alias("target"), F.col("failing").cast("bigint").alias("failing_rows"),
        F.col("failing").cast("double").alias("observed"), (F.col("failing") == 0).alias("passed"),
    )


def unique(table: str, col: str) -> Check:
    """Number of values that occur more than once; nulls are ignored."""
    def build(tables):
        counts = tables[table].filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
        return _one_row("unique", f"{table}.{col}", counts.agg(F.count(F.when(F.col("n") > 1, 1)).alias("failing")))

    return Check("unique", table, col, build=build)


def relationships(table: str, col: str, parent: str, key: str) -> Check:
    """Rows whose non-null key has no parent. Keys are counted first, so that a hot key is one row in the join."""
    def build(tables):
        keys = tables[table].filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
        owners = tables[parent].select(F.col(key).alias("_key"))
        orphans = keys.join(owners, F.col(col) == F.col("_key"), "left_anti")
        return _one_row("relationships", f"{table}.{col}", orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing")))

    return Check("relationships", table, col, build=build)


def reconcile(left: str, right: str, by: str) -> Check:
    """Groups whose row counts differ between two tables."""
    def build(tables):
        def side(name, sign):
            return tables[name].groupBy(by).agg((F.count("*") * sign).alias("n"))

        diff = side(left, 1).unionByName(side(right, -1)).groupBy(by).agg(F.sum("n").alias("n"))
        counted = diff.agg(F.count(F.when(F.col("n") != 0, 1)).alias("failing"))
        return _one_row("reconcile", f"{left}~{right}.{by}", counted)

    return Check("reconcile", left, by, build=build)


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All checks as one report. Scan checks on the same table become one aggregation."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks if c.scan):
        group = [c for c in checks if c.scan and c.table == table]
        entries = []
        for c in group:
            failing, observed, passed = c.scan()
            entries.append(F.struct(
                F.lit(c.name).alias("check"), F.lit(f"{table}.{c.target}").alias("target"),
                failing.alias("failing_rows"), observed.alias("observed"), passed.alias("passed"),
            ))
        parts.append(tables[table].agg(F.array(*entries).alias("r")).select(F.inline("r")))
    parts += [c.build(tables) for c in checks if c.build]
    return reduce(DataFrame.unionByName, parts)
