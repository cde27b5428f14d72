"""Quality rules by document and by host.

Each document gets a few counts of its text and fails if a rule on them does. Failures are summed by host, each host's
failure rate is shrunk towards all hosts' rates by an empirical beta prior, and a host whose shrunk rate is too high
takes its other documents with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, raw_texts, store, table, with_text

WINDOW = 8
SYMBOLS = "#*$%&|<>"  # fixed by the contract of the query
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A host is rejected when its shrunk failure rate exceeds this.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight in documents: it never vanishes, and never outweighs this many documents of a host.
MIN_PRIOR, MAX_PRIOR = 2.0, 1000.0
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` (a power of two) words that occur twice or more, by exact doubling of names."""
    if len(words) <= window:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    width = 1
    while width < window:
        left, right = ids[:-width], ids[width:]
        _, ids = np.unique(left * (int(ids.max()) + 1) + right, return_inverse=True)
        width *= 2
        if len(ids) == int(ids.max()) + 1:  # all distinct already
            return 0
    hit = np.bincount(ids)[ids] >= 2
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def dup_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            n += line in seen
            seen.add(line)
    return n


def text_stats(raw: bytes) -> tuple[int, int, int, int, int]:
    text = raw.decode("utf-8", "replace")
    words = raw.split()
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
        dup_lines(text) if "\n" in text else 0, repeated_words(words),
    )


def document_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts STATS of every whole text; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = np.array([text_stats(t) for t in raw_texts(b, at)], np.int64).reshape(-1, len(STATS))
            yield batch(**{c: b.column(i) for i, c in enumerate(keep)}, **{c: stats[:, i] for i, c in enumerate(STATS)})

    chosen, at = with_text(docs, keep, text)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[: len(keep)]] + [f"{c} bigint" for c in STATS])
    return arrow_map(chosen, run, fields)


def host_rates(docs: DataFrame, host: str, failed: str) -> DataFrame:
    """``(host, n_docs, n_failed, host_rate)``: failure rates by host, shrunk by a beta prior fitted to all hosts.

    The prior's mean is the share of failures over all documents; its weight follows from the spread of the hosts'
    rates beyond what chance gives (method of moments). Null hosts have no row.
    """
    hosts = docs.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(
        F.count("*").alias("k"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("n2"), F.sum(rate * F.col("n_failed")).alias("fr"),
    ).first()
    n, f = float(sums["n"] or 0), float(sums["f"] or 0)
    mean = (f + 0.5) / (n + 1.0)
    # Weighted between-host sum of squares and its expectation under chance alone.
    spread = float(sums["fr"] or 0) - 2 * mean * f + mean * mean * n
    free = n - float(sums["n2"] or 0) / n if n else 0.0
    noise = mean * (1 - mean)
    between = max((spread - (sums["k"] - 1) * noise) / free, 0.0) if free > 0 else 0.0
    weight = min(max(noise / between - 1 if between > 0 else MAX_PRIOR, MIN_PRIOR), MAX_PRIOR)
    return hosts.withColumn("host_rate", (F.col("n_failed") + F.lit(weight * mean)) / (F.col("n_docs") + F.lit(weight)))


def apply_rules(docs: DataFrame, keep: list[str], host: str = "source", text: str = "text", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per document: ``keep``, counts, base_failed, host_rate, kept.

    An empty or null text has zero words and fails. Repeated rows count each. A document without a host depends on its
    own counts alone. Hosts are joined back by Spark's choice of join: a small host table is sent to all tasks, a large
    one is shuffled, where skewed hosts are split.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    hosted = docs.withColumn("_host", F.col(host))
    stats = document_stats(hosted, [*keep, "_host"], text).withColumn("base_failed", failed)
    if text in keep:
        # Texts are not stored to join a host's verdict; their counts are made again.
        rates = store(host_rates(document_stats(hosted, ["_host"], text).select("_host", failed.alias("base_failed")), "_host", "base_failed"))
    else:
        stats = store(stats)
        rates = store(host_rates(stats, "_host", "base_failed"))
    return (
        stats.join(rates.select("_host", "host_rate"), "_host", "left")
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= max_host_rate))
        .select(*keep, *STATS, "base_failed", "host_rate", "kept")
    )


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), ["doc_id"]).drop("host_rate")


QUERIES = {"op9_host_rules": op9_host_rules}
ORACLES = {
    "op9_host_rules": r"""
with w as (
  select doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
),
win as (
  select doc_id, i, list_slice(ws, i, i + 7) as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)
),
hit as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from win) where n >= 2
),
rep as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as p from hit) group by doc_id
),
lines as (
  select doc_id, sum(n - 1)::bigint as n_dup_lines from (
    select doc_id, l, count(*) as n from (select doc_id, unnest(string_split(text, chr(10))) as l from w)
    where regexp_matches(l, '[^\x20\x09-\x0D]') group by doc_id, l
  ) group by doc_id
),
s as (
  select w.doc_id, w.source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from w left join lines using (doc_id) left join rep using (doc_id)
),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from s),
h as (
  select source, count(*)::double as n, sum(base_failed::int)::double as f from b where source is not null group by source
),
t as (
  select count(*)::double as k, sum(n) as nn, sum(f) as ff, sum(n * n) as n2, sum(f / n * f) as fr,
         (sum(f) + 0.5) / (sum(n) + 1) as m from h
),
p as (
  select m, m * (1 - m) as noise,
         greatest((fr - 2 * m * ff + m * m * nn - (k - 1) * m * (1 - m)) / (nn - n2 / nn), 0) as between_hosts from t
),
r as (
  select source, (f + a * m) / (n + a) as host_rate from h, (
    select m, least(greatest(case when between_hosts > 0 then noise / between_hosts - 1 else 1000 end, 2), 1000) as a from p
  )
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(host_rate, 0) <= 0.5 as kept
from b left join r using (source)
"""
}
