"""Session helpers: lineage cuts, shared scratch space and checked broadcasts."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when a count has shown that it stays below this many rows.
BROADCAST_ROWS = 100_000


def get_session(app: str = "perigee", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster the setting is required,
    because a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="perigee-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, inside the innermost open ``scratch_scope`` of this thread."""
    base = _SCOPE.get() or f"{shared_dir(spark).rstrip('/')}/perigee"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``scratch_path`` named."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, and shuffles of frames that are gone are given back.

    Frames made inside must not be used afterwards; results to keep are written to a path named outside.
    """
    path = scratch_path(spark, "scope")
    token = _SCOPE.set(path)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        drop_scratch(spark, path)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Gives back the shuffles of frames that are gone."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stores the frame as a table in the shared folder and reads it back, so the plan starts afresh.

    The data survives lost executors. Unlike an RDD checkpoint the stored table has a known size, so later joins with
    a small one are planned as broadcasts and larger ones as shuffles.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when at most ``limit`` rows exist; otherwise a hint to join by shuffle.

    Without the second hint the planner may still broadcast either side by its guess, which takes stored bytes for rows:
    a column that repeats itself is stored small. The probe reads no more than ``limit + 1`` rows.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else shuffled(df)


def shuffled(df: DataFrame) -> DataFrame:
    """Hint that neither side of the next join is broadcast by a guess of its size."""
    return df.hint("merge")


def small_table(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Computes a lookup frame once. Up to ``limit`` rows become a broadcast local relation; more stay distributed."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
