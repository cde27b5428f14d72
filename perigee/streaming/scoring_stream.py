"""Queue-style scoring as a stream: JSON requests in, scored JSON lines out, unreadable messages aside.

Each micro-batch overwrites its own ``batch_id`` folder, so a batch that is retried after a failure replaces what it
had written: every request is in the output once.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.operators.resolve import fetch_records, resolve
from perigee.operators.scoring import prediction_log, score
from perigee.session import cut_lineage
from perigee.spec import WITH_MOID, FeatureSpec

log = logging.getLogger(__name__)

MESSAGE = "identifier string"
RESULT_SCHEMA = (
    "identifier string, spkid bigint, is_pha boolean, probability double, explanation string, error string, scored_at double"
)


def submit(df: DataFrame, path: str) -> None:
    """Enqueues one message per row of ``identifier``."""
    df.select("identifier").write.mode("append").json(path)


def decode(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable requests, and dead letters: text that is no JSON object with an ``identifier``."""
    parsed = messages.withColumn("m", F.from_json("value", MESSAGE))
    known = F.col("m.identifier").isNotNull()
    return parsed.filter(known).select(F.col("m.identifier").alias("identifier")), parsed.filter(~known).select("value")


def score_requests(requests: DataFrame, model, fact: DataFrame, names: DataFrame, spec: FeatureSpec = WITH_MOID, **options) -> DataFrame:
    """Resolve, fetch, score. An unresolved identifier becomes an error row. Repeated identifiers are scored again."""
    distinct = cut_lineage(requests.select(F.trim("identifier").alias("identifier")).distinct())
    resolved = resolve(distinct, names, spec.id, **options)
    records = fetch_records(resolved, fact, names, spec.id)
    scored = cut_lineage(score(records, model, spec).withColumnRenamed("identifier", "asked"))
    joined = requests.join(scored, F.trim("identifier") == F.col("asked"), "left")
    return joined.select(
        "identifier", F.col(spec.id).alias("spkid"), "is_pha", "probability", "explanation",
        F.when(F.col(spec.id).isNull(), F.lit("not found")).alias("error"), *spec.features,
    )


def score_stream(
    spark: SparkSession, in_dir: str, out_dir: str, dead_dir: str, checkpoint: str, model, fact: DataFrame,
    names: DataFrame, spec: FeatureSpec = WITH_MOID, log_dir: str | None = None, files_per_batch: int = 1000, **options,
):
    """Drains what is available in batches of so many files, then stops. Returns the ``StreamingQuery``."""
    def process(batch: DataFrame, batch_id: int) -> None:
        # The batch is stored once: resolution reads it several times.
        messages = cut_lineage(batch)
        requests, dead = decode(messages)
        dead.write.mode("overwrite").text(f"{dead_dir}/batch_id={batch_id}")
        results = cut_lineage(score_requests(requests, model, fact, names, spec, **options))
        stamped = results.drop(*spec.features).withColumn("scored_at", F.current_timestamp().cast("double"))
        stamped.write.mode("overwrite").json(f"{out_dir}/batch_id={batch_id}")
        if log_dir is not None:
            try:
                prediction_log(results, spec.features).write.mode("overwrite").parquet(f"{log_dir}/batch_id={batch_id}")
            except Exception as exc:  # noqa: BLE001 - logging must not break scoring
                log.warning("prediction log failed: %s", exc)

    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(in_dir)
        .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_results(spark: SparkSession, out_dir: str) -> DataFrame:
    """Results of all batches, without the batch number that their folders carry."""
    return spark.read.schema(RESULT_SCHEMA).json(out_dir).drop("batch_id")
