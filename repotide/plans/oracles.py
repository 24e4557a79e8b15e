"""DuckDB SQL that gives the same rows as each query, over the whole test tables."""

from repotide.contract import ENTITIES, LANGUAGES, STOP_WORDS
from repotide.plans.registry import PART_WORDS
from repotide.plans.tables import EVENT_LANGUAGES, TEXT_LANGUAGES


def _quoted(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _rounded(expression, digits=2):
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)"


def _stamp(column):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


TARGETS = _quoted(TEXT_LANGUAGES)

EVENTS = """
ev AS (
  SELECT user_id AS id, event_id AS seq, event_type AS language,
         CAST(floor(value) AS BIGINT) AS stargazers_count, ts AS pushed_at,
         date_trunc('day', ts) + INTERVAL 1 DAY AS batch_time
  FROM events
)"""

UNIQUE = f"""{EVENTS},
uniq AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1)"""

BATCHES = f"""{EVENTS},
bu AS (
  SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY batch_time, id ORDER BY seq) = 1
)"""


def _history(age, targets):
    """Recent counts of every batch with the zeros of the missing targets."""
    return f"""{BATCHES},
hits AS (
  SELECT batch_time, language, count(*) AS n FROM bu
  WHERE batch_time - pushed_at <= INTERVAL {age} GROUP BY ALL
),
grid AS (
  SELECT b.batch_time, t.language
  FROM (SELECT DISTINCT batch_time FROM bu) b
  CROSS JOIN (SELECT unnest([{_quoted(targets)}]) AS language) t
),
hist AS (
  SELECT coalesce(h.batch_time, g.batch_time) AS batch_time,
         coalesce(h.language, g.language) AS language, coalesce(h.n, 0) AS count
  FROM hits h FULL JOIN grid g ON h.batch_time = g.batch_time AND h.language = g.language
)"""


HISTORY = _history("12 HOUR", EVENT_LANGUAGES)

WORDS = r"""
w AS (
  SELECT lang AS language, doc_id AS id,
         unnest([x FOR x IN
           string_split(lower(regexp_replace(text, '[^a-zA-Z ]', '', 'g')), ' ') IF x <> ''
         ]) AS word
  FROM documents
),
wc AS (SELECT language, word, count(*) AS count FROM w GROUP BY ALL),
top AS (
  SELECT language, word, count,
         CAST(row_number() OVER (PARTITION BY language ORDER BY count DESC, word) AS INTEGER) AS rank
  FROM wc QUALIFY rank <= 10
)"""

TRIMMED = "rtrim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
STOP = f"[x FOR x IN t IF x NOT IN ({_quoted(STOP_WORDS)})]"
TOKENS = rf"""
docs AS (SELECT doc_id AS id, lang AS language, text FROM documents
         WHERE text <> '' AND lang IN ({TARGETS})),
tok AS (
  SELECT id, language,
         CASE WHEN {TRIMMED} = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split_regex({TRIMMED}, '[ \t\n\v\f\r]') END AS t
  FROM docs
),
kept AS (SELECT id, language, {STOP} AS t FROM tok)"""


def _vocabulary(min_df):
    return f"""{TOKENS},
tf AS (
  SELECT language, id, term, count(*) AS tf
  FROM (SELECT language, id, unnest(t) AS term FROM kept) GROUP BY ALL
),
nd AS (SELECT language, count(*) AS docs FROM docs GROUP BY ALL),
vocab AS (
  SELECT language, term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_count,
         CAST(row_number() OVER (PARTITION BY language ORDER BY sum(tf) DESC, term) AS INTEGER)
           AS rank
  FROM tf GROUP BY language, term HAVING count(*) >= {min_df} QUALIFY rank <= 1000
),
idf AS (
  SELECT language, term, doc_count, ln((docs + 1) / (doc_count + 1)) AS idf
  FROM vocab JOIN nd USING (language)
),
wt AS (
  SELECT language, id, term, tf, tf * idf AS weight FROM tf JOIN idf USING (language, term)
)"""


COSINE = f"""{_vocabulary(1)},
pos AS (
  SELECT id, language, row_number() OVER (PARTITION BY language ORDER BY id) AS p FROM docs
),
norm AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM wt GROUP BY id),
cand AS (
  SELECT a.language, a.id AS id1, b.id AS id2, a.p AS p1, b.p AS p2
  FROM pos a JOIN (SELECT language, id, p, unnest(range(1, 6)) AS k FROM pos) b
    ON a.language = b.language AND a.p = b.p - b.k
),
sims AS (
  SELECT c.language, id1, id2, p1, p2, sum(x.weight * y.weight) AS dot
  FROM cand c JOIN wt x ON x.id = c.id1 JOIN wt y ON y.id = c.id2 AND y.term = x.term
  GROUP BY ALL
),
cosine AS (
  SELECT s.language, id1, id2, p1, p2, {_rounded("dot / (a.norm * b.norm)", 3)} AS similarity
  FROM sims s JOIN norm a ON a.id = id1 JOIN norm b ON b.id = id2
  WHERE a.norm > 0 AND b.norm > 0 AND dot / (a.norm * b.norm) > 0.1
),
best AS (
  SELECT language, id1, id2, similarity,
         CAST(row_number() OVER (PARTITION BY language ORDER BY similarity DESC, p1, p2)
           AS INTEGER) AS rank
  FROM cosine QUALIFY rank <= 5
),
named AS (
  SELECT b.language, nd.docs AS total_repos_analyzed, rank, 'doc-' || id1 AS repo1,
         'doc-' || id2 AS repo2, similarity,
         substring(x.text, 1, 50) || '...' AS description1,
         substring(y.text, 1, 50) || '...' AS description2
  FROM best b JOIN nd USING (language) JOIN docs x ON x.id = id1 JOIN docs y ON y.id = id2
)"""


def _mentions(name, source, dictionary):
    """`source` has id, language, text."""
    rows = ", ".join(
        f"('{kind}', '{pattern}', {n})"
        for kind, patterns in dictionary.items()
        for n, pattern in enumerate(patterns)
    )
    return f"""
{name}dict(entity_type, name, entry) AS (VALUES {rows}),
{name} AS (
  SELECT d.language, d.id, e.entity_type, e.name, e.entry
  FROM ({source}) d JOIN {name}dict e ON contains(lower(d.text), e.name)
),
{name}top AS (
  SELECT language, entity_type, name, count(*) AS count,
         CAST(row_number() OVER (
           PARTITION BY language, entity_type ORDER BY count(*) DESC, min(id), min(entry)
         ) AS INTEGER) AS rank
  FROM {name} GROUP BY language, entity_type, name QUALIFY rank <= 5
)"""


DOC_MENTIONS = _mentions(
    "m",
    f"SELECT doc_id AS id, lang AS language, text FROM documents WHERE text <> '' AND lang IN ({TARGETS})",
    ENTITIES,
)
PART_MENTIONS = _mentions(
    "m", "SELECT p_partkey AS id, p_brand AS language, p_name AS text FROM part", PART_WORDS
)

TREND = f"""
roll AS (
  SELECT o_orderpriority AS language, strftime(o_orderdate, '%Y-%m') AS month,
         count(*) AS repo_count,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS total_stars,
         CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) * 100 AS BIGINT) AS cents
  FROM orders GROUP BY ALL
),
lagged AS (
  SELECT *, lag(repo_count) OVER (PARTITION BY language ORDER BY month) AS prev FROM roll
),
trend AS (
  SELECT language, month, repo_count, total_stars,
         ((2 * cents + repo_count) // (2 * repo_count)) / 100 AS avg_stars,
         coalesce({_rounded("(repo_count - prev) / prev * 100")}, 0.0) AS growth_rate
  FROM lagged
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY language ORDER BY month DESC) AS back,
         count(*) OVER (PARTITION BY language) AS total_months
  FROM trend
),
direction AS (
  SELECT language, total_months,
         CASE WHEN total_months < 3 THEN 'insufficient_data'
              WHEN avg(growth_rate) FILTER (WHERE back <= 3) > 10 THEN 'growing'
              WHEN avg(growth_rate) FILTER (WHERE back <= 3) < -10 THEN 'declining'
              ELSE 'stable' END AS trend_direction
  FROM numbered GROUP BY language, total_months
),
peak AS (
  SELECT language, month, repo_count, total_stars, avg_stars, growth_rate FROM trend
  QUALIFY row_number() OVER (PARTITION BY language ORDER BY repo_count DESC, month) = 1
)"""

EVENT_RECORDS = """SELECT user_id AS id, event_type AS language,
       CAST(floor(value) AS BIGINT) AS stargazers_count,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS pushed_at, event_id AS seq
FROM events"""

DOCUMENT_FIELDS = """SELECT doc_id AS id, 'doc-' || doc_id AS name, lang AS language,
       text AS description, n_chars AS stargazers_count FROM documents"""

UNIQUE_ROWS = f"""SELECT id, language, stargazers_count, {_stamp("pushed_at")} AS pushed_at, seq
FROM uniq"""

AVERAGES = f"""av AS (SELECT lang AS language, count(*) AS n,
  {_rounded("avg(n_chars)")} AS avg_stargazers_count FROM documents GROUP BY lang)"""

ORACLES = {
    "stream_ndjson_source": EVENT_RECORDS,
    "parse_repo_json": EVENT_RECORDS,
    "quarantine_bad_rows": "SELECT text AS line FROM documents",
    "flatten_search_items": "SELECT conv_id, turn, role, text FROM conversations",
    "source_language_filter": (
        "SELECT doc_id AS id, lang AS language FROM documents WHERE lang IN ('en', 'fr', 'de')"
    ),
    "project_repo_fields": DOCUMENT_FIELDS,
    "emit_ndjson": """
SELECT '{"id":' || user_id || ',"language":"' || event_type || '","stargazers_count":'
       || CAST(floor(value) AS BIGINT) || ',"pushed_at":"'
       || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","seq":' || event_id || '}' AS value
FROM events""",
    "sink_batch_history": f"WITH {UNIQUE} {UNIQUE_ROWS}",
    "batch_metrics": f"""WITH {EVENTS}
SELECT {_stamp("batch_time")} AS batch_time, count(*) AS input_rows,
       CAST(epoch(batch_time) - (SELECT epoch(min(batch_time)) - 86400 FROM ev) AS BIGINT)
         AS uptime_seconds
FROM ev GROUP BY ev.batch_time""",
    "dedup_first_seen": f"WITH {UNIQUE} {UNIQUE_ROWS}",
    "dedup_within_batch": f"""WITH {BATCHES}
SELECT id, language, stargazers_count, {_stamp("pushed_at")} AS pushed_at, seq,
       {_stamp("batch_time")} AS batch_time FROM bu""",
    "assign_batch": f"WITH {EVENTS} SELECT seq, id, {_stamp('batch_time')} AS batch_time FROM ev",
    "stream_lifetime_counts": f"WITH {UNIQUE} SELECT language, count(*) AS count FROM uniq GROUP BY ALL",
    "stream_avg_stars": f"""WITH {UNIQUE}
SELECT language, {_rounded("avg(stargazers_count)")} AS avg_stargazers_count
FROM uniq GROUP BY language""",
    "stream_recent_counts": f"""WITH {BATCHES}
SELECT {_stamp("batch_time")} AS batch_time, language, count(*) AS count FROM bu
WHERE batch_time - pushed_at <= INTERVAL 12 HOUR
GROUP BY bu.batch_time, language""",
    "stream_batch_metrics": """
SELECT 0::BIGINT AS batch, (SELECT count(*) FROM events) + n AS input_rows, n AS bad_rows, 0::BIGINT AS uptime_seconds
FROM (SELECT sum(len(string_split(text, chr(10))))::BIGINT AS n FROM documents)""",
    "arrival_order": f"SELECT user_id AS id, {_stamp('min(ts)')} AS pushed_at FROM events GROUP BY user_id",
    "available_languages": f"WITH {UNIQUE} SELECT DISTINCT language FROM uniq WHERE language <> ''",
    "total_count_by_language": f"WITH {UNIQUE} SELECT language, count(*) AS count FROM uniq GROUP BY ALL",
    "zero_fill_languages": f"""WITH {_history("1 HOUR", (*EVENT_LANGUAGES, "fork"))}
SELECT {_stamp("batch_time")} AS batch_time, language, count FROM hist""",
    "zero_fill_when_empty": f"""
WITH c AS (
  SELECT lang AS language, count(*) AS count FROM documents
  WHERE lang IN ({_quoted(LANGUAGES)}) GROUP BY lang
)
SELECT language, count FROM c
UNION ALL
SELECT t.language, CAST(0 AS BIGINT) FROM (SELECT unnest([{_quoted(LANGUAGES)}]) AS language) t
WHERE NOT EXISTS (SELECT 1 FROM c)""",
    "recent_push_counts": f"""WITH {BATCHES}
SELECT {_stamp("batch_time")} AS batch_time, language, count(*) AS count FROM bu
WHERE batch_time - pushed_at <= INTERVAL 12 HOUR GROUP BY bu.batch_time, language""",
    "recent_push_history": f"""WITH {HISTORY}
SELECT {_stamp("batch_time")} AS batch_time, language, count,
       strftime(batch_time, '%H:%M:%S') AS batch_label FROM hist""",
    "avg_stars_by_language": f"WITH {AVERAGES} SELECT language, avg_stargazers_count FROM av",
    "clean_words": r"""
WITH c AS (
  SELECT doc_id AS id, lang AS language,
         [x FOR x IN
           string_split(lower(regexp_replace(text, '[^a-zA-Z ]', '', 'g')), ' ') IF x <> ''
         ] AS w
  FROM documents
)
SELECT id, language, CAST(len(w) AS INTEGER) AS n_words, array_to_string(w, ' ') AS words FROM c""",
    "word_counts": f"WITH {WORDS} SELECT language, word, count FROM wc",
    "top_words_nested": f"""WITH {WORDS}
SELECT language, CAST(to_json(list({{'word': word, 'count': count}} ORDER BY rank)) AS VARCHAR) AS top_ten_words
FROM top GROUP BY language""",
    "zero_fill_when_present": "SELECT lang AS language, count(*) AS count FROM documents GROUP BY lang",
    "snapshot_rows": f"""WITH {HISTORY}, {AVERAGES}, {WORDS}
SELECT 'req1' AS section, lang AS language, NULL AS item, CAST(count(*) AS VARCHAR) AS value FROM documents GROUP BY lang
UNION ALL SELECT 'req2', language, strftime(batch_time, '%H:%M:%S'), CAST(count AS VARCHAR) FROM hist
UNION ALL SELECT 'req3', language, NULL, CAST(CAST(avg_stargazers_count AS DECIMAL(20,2)) AS VARCHAR) FROM av
UNION ALL SELECT 'req4', language, NULL, CAST(to_json(list({{'word': word, 'count': count}} ORDER BY rank)) AS VARCHAR)
FROM top GROUP BY language""",
    "top10_words": f"WITH {WORDS} SELECT language, word, count, rank FROM top",
    "text_eligible": (
        "SELECT doc_id AS id, lang AS language FROM documents WHERE text <> '' AND lang IN ('en', 'fr')"
    ),
    "min_docs_gate": f"""
WITH d AS (SELECT doc_id AS id, lang AS language FROM documents
           WHERE text <> '' AND lang IN ({TARGETS}))
SELECT id, language FROM d
WHERE language IN (SELECT language FROM d GROUP BY language HAVING count(*) >= 150)""",
    "ml_tokens": f"""WITH {TOKENS}
SELECT id, language, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM tok""",
    "stopword_filter": f"""WITH {TOKENS}
SELECT id, language, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM kept""",
    "vocab_topn": f"WITH {_vocabulary(2)} SELECT language, rank, term, corpus_count, doc_count FROM vocab",
    "term_frequency": f"""WITH {_vocabulary(1)}
SELECT language, id, term, tf FROM tf JOIN vocab USING (language, term)""",
    "idf_weights": f"""WITH {_vocabulary(1)}
SELECT language, term, doc_count, round(idf, 6) AS idf FROM idf""",
    "tfidf_vectors": f"""WITH {_vocabulary(1)}
SELECT language, id, term, tf, round(weight, 6) AS weight FROM wt""",
    "lda_failure_isolation": f"""WITH {_vocabulary(2)}
SELECT nd.language, nd.docs, coalesce(v.terms, 0) AS terms,
       CASE WHEN nd.docs < 150 THEN 'too few documents'
            WHEN coalesce(v.terms, 0) = 0 THEN 'empty vocabulary' ELSE 'ready' END AS status
FROM nd LEFT JOIN (SELECT language, count(*) AS terms FROM vocab GROUP BY ALL) v USING (language)""",
    "entity_dictionary": f"""WITH {DOC_MENTIONS}
SELECT d.entity_type, d.entry, d.name, count(m.id) AS documents
FROM mdict d LEFT JOIN m ON m.entity_type = d.entity_type AND m.name = d.name
GROUP BY d.entity_type, d.entry, d.name""",
    "entity_mentions": f"WITH {DOC_MENTIONS} SELECT language, id, entity_type, name FROM m",
    "entity_mentions_parts": f"WITH {PART_MENTIONS} SELECT language, id, entity_type, name FROM m",
    "entity_top5": f"WITH {DOC_MENTIONS} SELECT language, entity_type, rank, name, count FROM mtop",
    "entity_top5_parts": f"WITH {PART_MENTIONS} SELECT language, entity_type, rank, name, count FROM mtop",
    "entity_grid": f"""WITH {DOC_MENTIONS}
SELECT l.language, e.entity_type, CAST(count(t.name) AS INTEGER) AS found
FROM (SELECT unnest([{TARGETS}]) AS language) l
CROSS JOIN (SELECT unnest([{_quoted(ENTITIES)}]) AS entity_type) e
LEFT JOIN mtop t ON t.language = l.language AND t.entity_type = e.entity_type
GROUP BY l.language, e.entity_type""",
    "entity_display": f"""WITH {DOC_MENTIONS}
SELECT language, entity_type, string_agg(name || '(' || count || ')', ', ' ORDER BY rank) AS line
FROM mtop WHERE rank <= 3 GROUP BY language, entity_type""",
    "band_candidates": f"WITH {COSINE} SELECT language, id1, id2 FROM cand",
    "cosine_banded": f"WITH {COSINE} SELECT language, id1, id2, similarity FROM cosine",
    "similar_pairs_top5": f"""WITH {COSINE}
SELECT language, total_repos_analyzed, rank, repo1, repo2, similarity, description1, description2
FROM named""",
    "similarity_display": f"""WITH {COSINE}
SELECT nd.language, coalesce(p.pairs, '') AS pairs, nd.docs AS total_repos_analyzed
FROM nd LEFT JOIN (
  SELECT language, string_agg(repo1 || ' ' || repo2 || ' ' || similarity, '; ' ORDER BY rank) AS pairs
  FROM named GROUP BY language
) p USING (language) WHERE nd.docs >= 3""",
    "pair_lines": f"""WITH {COSINE}
SELECT language, repo1 || ' ↔ ' || repo2 || ': ' || similarity AS line FROM named""",
    "created_at_rows": """
SELECT o_orderkey AS id, o_orderpriority AS language, strftime(o_orderdate, '%Y-%m-%d') AS created_at
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "synthetic_created_at": f"""
SELECT doc_id AS id, lang AS language,
       strftime(
         TIMESTAMP '2024-07-01 00:00:00' - to_days(CAST(
           30 * ((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 6) AS INTEGER)),
         '%Y-%m-%d') AS created_at
FROM documents WHERE lang IN ({TARGETS})""",
    "monthly_rollup": f"WITH {TREND} SELECT language, month, repo_count, total_stars FROM roll",
    "monthly_avg_stars": f"WITH {TREND} SELECT language, month, avg_stars FROM trend",
    "monthly_growth": f"WITH {TREND} SELECT language, month, repo_count, growth_rate FROM trend",
    "trend_direction": f"WITH {TREND} SELECT language, trend_direction, total_months FROM direction",
    "last_6_months": f"""WITH {TREND}
SELECT language, month, repo_count, total_stars, avg_stars, growth_rate, total_months
FROM numbered WHERE back <= 6""",
    "peak_month": f"WITH {TREND} SELECT * FROM peak",
    "trend_display": f"""WITH {TREND}
SELECT language, trend_direction, total_months,
       CASE trend_direction WHEN 'growing' THEN 'green' WHEN 'declining' THEN 'red'
            ELSE 'orange' END AS trend_color
FROM direction""",
    "growth_arrow": f"""WITH {TREND}
SELECT language, month, growth_rate,
       CASE WHEN growth_rate > 0 THEN 'up' WHEN growth_rate < 0 THEN 'down' ELSE 'flat' END AS arrow,
       abs(growth_rate) AS change
FROM trend""",
    "trend_lines": f"""WITH {TREND}
SELECT language, 'Trend Direction: ' || trend_direction || '; Recent Months: ' || total_months
       || ' analyzed; Peak Month: ' || month || ' (' || repo_count || ' repos)' AS line
FROM direction JOIN peak USING (language)""",
    "activity_series_pivot": f"""WITH {HISTORY}
SELECT {_stamp("batch_time")} AS batch_time,
       {", ".join(f"max(count) FILTER (WHERE language = '{x}') AS {x}" for x in EVENT_LANGUAGES)}
FROM hist GROUP BY hist.batch_time""",
    "avg_stars_series": f"""WITH {AVERAGES}
SELECT CAST(row_number() OVER (ORDER BY language) - 1 AS INTEGER) AS position, language,
       avg_stargazers_count AS value
FROM av""",
    "word_lines": f"""WITH {WORDS}
SELECT language, string_agg(word || ', ' || count, chr(10) ORDER BY rank) AS lines
FROM top GROUP BY language""",
    "sample_count_lines": f"""WITH {AVERAGES}
SELECT language || ':' || n || ':' || avg_stargazers_count AS line FROM av""",
    "sample_word_lines": f"""WITH {WORDS}
SELECT language || ':' || string_agg('(' || word || ',' || count || ')', ',' ORDER BY rank) AS line
FROM top GROUP BY language""",
}
ORACLES["sample_output_lines"] = (
    f"({ORACLES['sample_count_lines']}) UNION ALL ({ORACLES['sample_word_lines']})"
)
ORACLES["console_summary_lines"] = (
    f"({ORACLES['pair_lines']}) UNION ALL ({ORACLES['trend_lines']})"
)
