"""Deterministic samples and splits of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.operators import sampling
from perigee.plans.population import rounded
from perigee.plans.registry import query, table
from perigee.spec import FeatureSpec

SAMPLE = 1000
_FLAGGED = "SELECT *, event_type = 'error' AS flag FROM events"


def flagged_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("flag", F.col("event_type") == "error")


def _ranked(source: str, salt: str, by: str = "flag") -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5(CAST(event_id AS VARCHAR) || '{salt}'), event_id)"
        f" AS rn FROM ({source})"
    )


@query("stratified_sample", f"""
    WITH ranked AS ({_ranked(_FLAGGED, '_sample_42')}),
    target AS (SELECT CAST(round({SAMPLE}.0e0 * sum(CASE WHEN flag THEN 1 ELSE 0 END) / count(*)) AS BIGINT) AS p FROM ranked)
    SELECT event_id, flag, value FROM ranked CROSS JOIN target WHERE rn <= CASE WHEN flag THEN p ELSE {SAMPLE} - p END""")
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(flagged_events(spark, sf_dir), "event_id", "flag", SAMPLE, "_sample_42").select(
        "event_id", "flag", "value"
    )


@query("uniform_sample", f"""
    SELECT event_id, event_type, value FROM events
    ORDER BY md5(CAST(event_id AS VARCHAR) || '_uniform_42'), event_id LIMIT 2000""")
def uniform_sample(spark, sf_dir):
    return sampling.uniform_sample(table(spark, sf_dir, "events"), "event_id", 2000, "_uniform_42").select(
        "event_id", "event_type", "value"
    )


@query("fixture_sample", f"""
    WITH edge AS (SELECT *, value > 200 AS is_edge FROM ({_FLAGGED})),
    ranked AS ({_ranked('SELECT * FROM edge WHERE NOT is_edge', '_fixture')})
    SELECT event_id, flag, value FROM ranked WHERE rn <= CASE WHEN flag THEN 11 ELSE 489 END
    UNION ALL SELECT event_id, flag, value FROM edge WHERE is_edge""")
def fixture_sample(spark, sf_dir):
    out = sampling.fixture_sample(
        flagged_events(spark, sf_dir), "event_id", "flag", {True: 11, False: 489}, "_fixture", F.col("value") > 200
    )
    return out.select("event_id", "flag", "value")


_SPLIT = f"""
    ranked AS ({_ranked(_FLAGGED, '_split_42')}), sized AS (SELECT *, count(*) OVER (PARTITION BY flag) AS n FROM ranked),
    parts AS (SELECT *, CASE WHEN rn <= round(n * 0.2e0) THEN 'test' WHEN rn <= round(n * 0.4e0) THEN 'val'
                        ELSE 'train' END AS split FROM sized)"""


@query("three_way_split", f"WITH {_SPLIT} SELECT event_id, flag, split FROM parts")
def three_way_split(spark, sf_dir):
    return sampling.three_way_split(flagged_events(spark, sf_dir), "event_id", "flag").select("event_id", "flag", "split")


@query("split_checks", f"""
    WITH {_SPLIT} SELECT split, count(*) AS n, CAST(sum(CASE WHEN flag THEN 1 ELSE 0 END) AS BIGINT) AS positives,
      CAST(0 AS BIGINT) AS shared_keys FROM parts GROUP BY split""")
def split_checks(spark, sf_dir):
    split = sampling.three_way_split(flagged_events(spark, sf_dir), "event_id", "flag")
    return sampling.check_splits(split, "event_id", "flag")


# A rare label over two numeric features and one code: toxic documents by length and share of their text.
DOC_SQL = """docs AS (SELECT d.doc_id, toxic, CAST(n_chars AS DOUBLE) / 997 AS size,
      CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) / 101 AS gaps,
      CASE lang WHEN 'en' THEN 0.0e0 WHEN 'de' THEN 1.0e0 WHEN 'fr' THEN 2.0e0 ELSE 3.0e0 END AS code
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.selectExpr(
        "doc_id", "toxic", "CAST(n_chars AS DOUBLE) / 997 AS size",
        "CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) / 101 AS gaps",
        "CASE lang WHEN 'en' THEN 0D WHEN 'de' THEN 1D WHEN 'fr' THEN 2D ELSE 3D END AS code",
    )


_UNIT = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0e0"
_SMOTE = f"""{DOC_SQL},
    minority AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '_smote_42'), doc_id) AS pos
                 FROM docs WHERE toxic = 1),
    sizes AS (SELECT (SELECT count(*) FROM minority) AS n, (SELECT count(*) FROM docs WHERE toxic = 0) AS m),
    pairs AS (SELECT a.doc_id, b.size AS nsize, b.gaps AS ngaps, row_number() OVER (PARTITION BY a.doc_id ORDER BY
                sqrt((a.size-b.size)*(a.size-b.size) + (a.gaps-b.gaps)*(a.gaps-b.gaps) + (a.code-b.code)*(a.code-b.code)),
                b.doc_id) AS rank
              FROM minority a JOIN minority b ON a.doc_id <> b.doc_id),
    news AS (SELECT unnest(range(CAST((SELECT m - n FROM sizes) AS BIGINT))) AS copy),
    placed AS (SELECT copy, copy * n // (m - n) + 1 AS pos FROM news CROSS JOIN sizes),
    draws AS (SELECT doc_id, copy, size, gaps, code,
        CAST(floor({_UNIT.format("doc_id || '|' || copy || '|n42'")} * 5) AS INTEGER) + 1 AS rank,
        {_UNIT.format("doc_id || '|' || copy || '|g42'")} AS gap
      FROM placed JOIN minority USING (pos))"""


@query("smote_rows", f"""
    WITH {_SMOTE} SELECT d.doc_id AS base_id, copy, round(d.size + gap * (nsize - d.size), 6) AS size,
      round(d.gaps + gap * (ngaps - d.gaps), 6) AS gaps, d.code FROM draws d JOIN pairs p
      ON d.doc_id = p.doc_id AND d.rank = p.rank""")
def smote_rows(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir)
    counts = {r["toxic"]: r["count"] for r in docs.groupBy("toxic").count().collect()}
    spec = FeatureSpec("doc_id", "toxic", ("size", "gaps", "code"), ("code",))
    return rounded(sampling.smote_rows(docs.filter("toxic = 1"), spec, counts[0] - counts[1]))


@query("smote_counts", f"""
    WITH {DOC_SQL}, n AS (SELECT count(*) FILTER (toxic = 0) AS m, count(*) FILTER (toxic = 1) AS k FROM docs)
    SELECT 0 AS toxic, false AS synthetic, m AS n FROM n UNION ALL SELECT 1, false, k FROM n
    UNION ALL SELECT 1, true, m - k FROM n""")
def smote_counts(spark, sf_dir):
    spec = FeatureSpec("doc_id", "toxic", ("size", "gaps", "code"), ("code",))
    out = sampling.smote(labelled_docs(spark, sf_dir), spec)
    return out.groupBy("toxic", "synthetic").agg(F.count("*").alias("n"))
