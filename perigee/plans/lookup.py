"""Identifier resolution over parts, and request validation, rules and explanations over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from perigee.functions.text import explain_column
from perigee.operators import name_search as ns
from perigee.operators import resolve as rs
from perigee.operators import scoring
from perigee.plans.population import rounded, split_columns
from perigee.plans.registry import query, table
from perigee.session import scratch_path

# Parts play the names dimension. Every part also sends one request: its key, name, designation, a piece of its full
# name, a name with a lost letter, one with swapped letters, a blank or nonsense.
NAMES = """p_partkey AS spkid,
    CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE p_name END AS name,
    p_name || ' (' || p_type || ' ' || p_partkey || ')' AS full_name,
    p_brand || '/' || p_partkey AS pdes"""
REQUESTS = """p_partkey AS request_id,
    CASE p_partkey % 8 WHEN 0 THEN CAST(p_partkey AS STRING) WHEN 1 THEN upper(p_name)
      WHEN 2 THEN ' ' || p_brand || '/' || p_partkey WHEN 3 THEN lower(p_type) || ' ' || p_partkey
      WHEN 4 THEN substr(p_name, 1, 1) || substr(p_name, 3)
      WHEN 5 THEN substr(p_name, 1, length(p_name) - 2) || substr(p_name, length(p_name), 1) || substr(p_name, length(p_name) - 1, 1)
      WHEN 6 THEN '  ' ELSE 'zzqq% ' || substr(p_brand, 1, 2) || ' fox jumps' END AS identifier"""


def part_names(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*split_columns(NAMES))


def part_requests(spark, sf_dir):
    first, rest = REQUESTS.split(",\n", 1)
    return table(spark, sf_dir, "part").selectExpr(first, rest.replace("\n", " "))


_BASE = f"""
    names AS (SELECT {NAMES} FROM part), requests AS (SELECT {REQUESTS.replace('STRING', 'VARCHAR')} FROM part),
    queries AS (SELECT DISTINCT trim(identifier) AS q FROM requests WHERE trim(identifier) <> ''),
    hits AS (
      SELECT q, spkid, 1 AS rank FROM queries JOIN names ON CAST(spkid AS VARCHAR) = q
      UNION ALL SELECT q, spkid, 2 FROM queries JOIN names ON lower(name) = lower(q)
      UNION ALL SELECT q, spkid, 3 FROM queries JOIN names ON pdes = q
      UNION ALL SELECT q, spkid, 4 FROM queries JOIN names ON contains(lower(full_name), lower(q)))"""
_FUZZY = f"""{_BASE},
    open AS (SELECT q FROM queries WHERE q NOT IN (SELECT q FROM hits)),
    fields AS (SELECT spkid, 'name' AS field, 2.0e0 AS w, name AS text FROM names
      UNION ALL SELECT spkid, 'full_name', 1.0e0, full_name FROM names UNION ALL SELECT spkid, 'pdes', 1.0e0, pdes FROM names),
    words AS (SELECT DISTINCT spkid, field, w, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM fields),
    tokens AS (SELECT DISTINCT q, unnest(string_split_regex(lower(q), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM open),
    vocab AS (SELECT DISTINCT word FROM words WHERE word <> ''),
    near AS (SELECT token, word, damerau_levenshtein(token, word) AS d FROM (SELECT DISTINCT token FROM tokens WHERE token <> '')
      CROSS JOIN vocab WHERE damerau_levenshtein(token, word) <=
        CASE WHEN length(token) <= 2 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END),
    scored AS (SELECT q, spkid, field, w, token, max(1 - d::DOUBLE / greatest(length(token), length(word))) AS c
      FROM tokens JOIN near USING (token) JOIN words USING (word) GROUP BY ALL),
    by_field AS (SELECT q, spkid, field, sum(c) * any_value(w) AS s FROM scored GROUP BY q, spkid, field),
    by_key AS (SELECT q, spkid, max(round(s, 9)) AS score FROM by_field GROUP BY q, spkid),
    cands AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, spkid) AS rank FROM by_key QUALIFY rank <= 5),
    sims AS (SELECT c.q, c.spkid, rank, max(CASE WHEN text IS NULL THEN NULL ELSE
        1 - levenshtein(lower(trim(c.q)), lower(trim(text)))::DOUBLE / greatest(length(trim(c.q)), length(trim(text))) END) AS ratio
      FROM cands c JOIN fields f ON c.spkid = f.spkid GROUP BY c.q, c.spkid, rank),
    best AS (SELECT q, spkid, ratio FROM sims QUALIFY row_number() OVER (PARTITION BY q ORDER BY ratio DESC, rank) = 1),
    accepted AS (SELECT * FROM best WHERE ratio >= 0.6e0),
    resolved AS (
      SELECT q, spkid, CASE rank WHEN 1 THEN 'key' WHEN 2 THEN 'name' WHEN 3 THEN 'designation' ELSE 'substring' END AS strategy
      FROM hits QUALIFY row_number() OVER (PARTITION BY q ORDER BY rank, spkid) = 1
      UNION ALL SELECT q, spkid, 'fuzzy' FROM accepted)"""


def _open_queries(spark, sf_dir):
    names = part_names(spark, sf_dir)
    queries = part_requests(spark, sf_dir).selectExpr("trim(identifier) AS q").filter("q <> ''").distinct()
    return rs.unmatched(queries, names), names


@query("substring_matches", f"""
    WITH {_BASE} SELECT q, min(spkid) AS "key" FROM hits WHERE rank = 4 GROUP BY q""")
def substring_matches(spark, sf_dir):
    queries = part_requests(spark, sf_dir).selectExpr("trim(identifier) AS q").filter("q <> ''").distinct()
    return rs.match_substring(queries, part_names(spark, sf_dir))


@query("fuzzy_candidates", f"""
    WITH {_FUZZY} SELECT q, spkid AS "key", round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM cands""")
def fuzzy_candidates(spark, sf_dir):
    queries, names = _open_queries(spark, sf_dir)
    return rounded(rs.fuzzy_candidates(queries, names))


@query("fuzzy_best", f"""WITH {_FUZZY} SELECT q, spkid AS "key", round(ratio, 6) AS ratio FROM accepted""")
def fuzzy_best(spark, sf_dir):
    queries, names = _open_queries(spark, sf_dir)
    candidates = rs.fuzzy_candidates(queries, names)
    return rounded(rs.fuzzy_best(candidates, names, min_ratio=0.6, method="edits"))


@query("resolve_identifiers", f"""
    WITH {_FUZZY} SELECT request_id, identifier, r.spkid, strategy, name, full_name, pdes, p_retailprice
    FROM requests LEFT JOIN resolved r ON trim(identifier) = q LEFT JOIN names n ON r.spkid = n.spkid
    LEFT JOIN part ON r.spkid = p_partkey""")
def resolve_identifiers(spark, sf_dir):
    names = part_names(spark, sf_dir)
    resolved = rs.resolve(part_requests(spark, sf_dir), names, min_ratio=0.6, method="edits")
    fact = table(spark, sf_dir, "part").selectExpr("p_partkey AS spkid", "p_retailprice")
    return rs.fetch_records(resolved, fact, names).select(
        "request_id", "identifier", "spkid", "strategy", "name", "full_name", "pdes", "p_retailprice"
    )


_RELEVANCE = f"""{_BASE},
    asked AS (SELECT q FROM queries WHERE q NOT IN (SELECT q FROM hits)),
    fields AS (SELECT spkid, 'name' AS field, 2.0e0 AS w, name AS text FROM names
      UNION ALL SELECT spkid, 'full_name', 1.0e0, full_name FROM names UNION ALL SELECT spkid, 'pdes', 1.0e0, pdes FROM names),
    spread AS (SELECT spkid, field, w, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM fields),
    tfs AS (SELECT spkid, field, w, word, count(*) AS tf FROM spread WHERE word <> '' GROUP BY ALL),
    sized AS (SELECT *, sum(tf) OVER (PARTITION BY spkid, field) AS len FROM tfs),
    lens AS (SELECT field, count(*) AS n, avg(len) AS mean FROM (SELECT DISTINCT spkid, field, len FROM sized) GROUP BY field),
    dfs AS (SELECT field, word, count(*) AS df FROM tfs GROUP BY field, word),
    tokens AS (SELECT DISTINCT q, unnest(string_split_regex(lower(q), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM asked),
    near AS (SELECT token, word, 1 - damerau_levenshtein(token, word)::DOUBLE / greatest(length(token), length(word)) AS c
      FROM (SELECT DISTINCT token FROM tokens WHERE token <> '') CROSS JOIN (SELECT DISTINCT word FROM tfs) WHERE damerau_levenshtein(token, word) <=
        CASE WHEN length(token) <= 2 THEN 0 WHEN length(token) <= 5 THEN 1 ELSE 2 END),
    gains AS (SELECT q, spkid, field, w, token, max(c * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len / mean))) AS gain
      FROM tokens JOIN near USING (token) JOIN sized USING (word) JOIN lens USING (field) JOIN dfs USING (field, word) GROUP BY q, spkid, field, w, token),
    by_field AS (SELECT q, spkid, field, round(sum(gain) * any_value(w), 9) AS s FROM gains GROUP BY q, spkid, field),
    ranked AS (SELECT q, spkid, max(s) AS score FROM by_field GROUP BY q, spkid)"""
RELEVANT_SQL = f"""
    WITH {_RELEVANCE} SELECT q, spkid AS "key", round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, spkid) AS INTEGER) AS rank
    FROM ranked QUALIFY rank <= 5"""


def indexed(spark, names, **options):
    path = scratch_path(spark, "names")
    counts = ns.write_index(names, path, **options)
    return ns.open_index(spark, path), counts


@query("search_candidates", RELEVANT_SQL)
def search_candidates(spark, sf_dir):
    """Identifiers that no exact form answers, looked up in a stored index by relevance."""
    queries, names = _open_queries(spark, sf_dir)
    return rounded(indexed(spark, names)[0].candidates(queries))


@query("search_candidates_common_words", RELEVANT_SQL)
def search_candidates_common_words(spark, sf_dir):
    """The same with nearly every word so common that it is searched through groups of names."""
    queries, names = _open_queries(spark, sf_dir)
    return rounded(indexed(spark, names, hot=20)[0].candidates(queries))


@query("index_counts", """
    WITH f AS (SELECT p_partkey AS k, 'name' AS field, CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE p_name END AS text FROM part
      UNION ALL SELECT p_partkey, 'full_name', p_name || ' (' || p_type || ' ' || p_partkey || ')' FROM part
      UNION ALL SELECT p_partkey, 'pdes', p_brand || '/' || p_partkey FROM part),
    w AS (SELECT DISTINCT k, field, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM f)
    SELECT (SELECT count(*) FROM part) AS n_names, count(DISTINCT word) AS n_words, count(*) AS n_postings FROM w WHERE word <> ''""")
def index_counts(spark, sf_dir):
    return indexed(spark, part_names(spark, sf_dir))[1]


@query("name_index", """
    WITH f AS (SELECT p_partkey AS "key", 'name' AS field, CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE p_name END AS text FROM part
      UNION ALL SELECT p_partkey, 'full_name', p_name || ' (' || p_type || ' ' || p_partkey || ')' FROM part
      UNION ALL SELECT p_partkey, 'pdes', p_brand || '/' || p_partkey FROM part),
    w AS (SELECT DISTINCT "key", field, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM f)
    SELECT "key", field, word FROM w WHERE word <> ''""")
def name_index(spark, sf_dir):
    return rs.name_index(part_names(spark, sf_dir))


# Events play bodies and scoring requests: six features, some out of bounds or missing.
BODIES = """event_id AS spkid,
    CAST(user_id % 97 AS DOUBLE) / 97 AS e,
    value / 77 AS q,
    10 + CAST(json_k % 60 AS DOUBLE) / 3 AS H,
    value < 100 AS is_neo,
    CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS INT) AS class_code,
    value / 49 AS moid"""
_K_SQL = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"
BODY_SQL = f"bodies AS (SELECT {BODIES.replace('AS INT)', 'AS INTEGER)')} FROM (SELECT *, {_K_SQL} AS json_k FROM events))"


def bodies(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("json_k", F.get_json_object("props", "$.k").cast("bigint"))
    return events.selectExpr(*split_columns(BODIES))


_REQUEST_BODY = """spkid,
    CASE WHEN spkid % 11 = 1 THEN e + 1 WHEN spkid % 11 = 2 THEN NULL ELSE e END AS e,
    CASE WHEN spkid % 13 = 1 THEN -q ELSE q END AS q,
    CASE WHEN spkid % 17 = 1 THEN 45D ELSE H END AS H,
    CASE WHEN spkid % 19 = 1 THEN NULL ELSE is_neo END AS is_neo,
    CASE WHEN spkid % 23 = 1 THEN 99 ELSE class_code END AS class_code,
    CASE WHEN spkid % 29 = 1 THEN -1D ELSE moid END AS moid"""
_REQUEST_SQL = (
    f"{BODY_SQL}, asked AS (SELECT {_REQUEST_BODY.replace('45D', '45.0e0').replace('-1D', '-1.0e0')} FROM bodies)"
)


@query("validate_requests", f"""
    WITH {_REQUEST_SQL} SELECT spkid, CAST(concat_ws(',',
      CASE WHEN e >= 0 AND e < 1 THEN NULL ELSE 'e' END, CASE WHEN q > 0 THEN NULL ELSE 'q' END,
      CASE WHEN H > -5 AND H < 40 THEN NULL ELSE 'H' END, CASE WHEN is_neo IS NULL THEN 'is_neo' END,
      CASE WHEN class_code BETWEEN 0 AND 12 THEN NULL ELSE 'class_code' END,
      CASE WHEN moid >= 0 THEN NULL ELSE 'moid' END) AS VARCHAR) AS errors FROM asked""")
def validate_requests(spark, sf_dir):
    asked = bodies(spark, sf_dir).selectExpr(*split_columns(_REQUEST_BODY))
    return scoring.validate(asked).select("spkid", F.array_join("errors", ",").alias("errors"))


@query("route_requests", f"""
    WITH {_REQUEST_SQL}, r AS (SELECT *, CASE WHEN spkid % 3 = 0 THEN CAST(spkid AS VARCHAR) WHEN spkid % 3 = 1 THEN '' END AS identifier FROM asked)
    SELECT spkid, CASE WHEN identifier <> '' THEN 'lookup' WHEN e IS NOT NULL AND q IS NOT NULL AND H IS NOT NULL AND
      is_neo IS NOT NULL AND class_code IS NOT NULL AND moid IS NOT NULL THEN 'values' ELSE 'error' END AS route FROM r""")
def route_requests(spark, sf_dir):
    asked = bodies(spark, sf_dir).selectExpr(*split_columns(_REQUEST_BODY)).withColumn(
        "identifier", F.expr("CASE WHEN spkid % 3 = 0 THEN CAST(spkid AS STRING) WHEN spkid % 3 = 1 THEN '' END")
    )
    return scoring.route_requests(asked).select("spkid", "route")


@query("rule_flags", f"""
    WITH {BODY_SQL} SELECT spkid, moid <= 0.05 AND H <= 22 AS rule_met, (moid <= 0.05 AND H <= 22) = is_neo AS rule_agrees FROM bodies""")
def rule_flags(spark, sf_dir):
    return scoring.rule_flags(bodies(spark, sf_dir), pred="is_neo").select("spkid", "rule_met", "rule_agrees")


_PROB = "CAST(spkid % 997 AS DOUBLE) / 997"


@query("explain_text", f"""
    WITH {BODY_SQL}, p AS (SELECT *, {_PROB} AS prob, {_PROB} > 0.5 AS pha, moid <= 0.05 AS mo, H <= 22 AS ho FROM bodies)
    SELECT spkid, 'Model prediction: ' || CASE WHEN pha THEN '' ELSE 'not ' END || 'potentially hazardous (probability='
      || format('{{:.3f}}', round(prob, 3)) || '). NASA''s PHA definition requires MOID <= 0.05 AU AND H <= 22.0. '
      || 'This object has MOID = ' || format('{{:.4f}}', round(moid, 4)) || ' AU (' || CASE WHEN mo THEN '<=' ELSE '>' END
      || ' 0.05 AU, condition ' || CASE WHEN mo THEN '' ELSE 'not ' END || 'met) and H = ' || format('{{:.2f}}', round(H, 2))
      || ' (' || CASE WHEN ho THEN '<=' ELSE '>' END || ' 22.0, condition ' || CASE WHEN ho THEN '' ELSE 'not ' END
      || 'met). The model''s prediction is ' || CASE WHEN (mo AND ho) = pha THEN 'consistent with' ELSE 'in tension with' END
      || ' NASA''s two-condition rule applied directly to this object''s MOID and H.' AS explanation FROM p""")
def explain_text(spark, sf_dir):
    rows = bodies(spark, sf_dir).withColumn("prob", F.expr(_PROB))
    return rows.select("spkid", explain_column(
        F.col("moid"), F.col("H"), F.col("prob") > 0.5, F.col("prob")
    ).alias("explanation"))
