"""Queries of the forms that grow with their input: state, windows, totals and indexes.

Each reads whole test tables; those that work in batches deal a table out to several and must give
what one pass over it gives.
"""

from pyspark.sql import functions as F

from repotide.contract import TOPIC_WORDS, TOPICS
from repotide.operators import counts, display, entities, entity_index, similarity, topics, vocabulary
from repotide.plans import report, tables
from repotide.plans.oracles import (
    BATCHES,
    COSINE,
    DOCUMENT_FIELDS,
    DOC_MENTIONS,
    EVENT_RECORDS,
    EVENTS,
    ORACLES,
    TARGETS,
    TREND,
    UNIQUE,
    _rounded,
    _stamp,
    _vocabulary,
)
from repotide.plans.registry import AS_OF, DAY, EVENT_SCHEMA, HALF_DAY, PAGE, TEXT_LANGUAGES, _docs, as_text, query
from repotide.scratch import scratch_path
from repotide.sources import pages, search, snapshots, tiers
from repotide.streaming import bands, expiry, lifetime, terms, windows
from repotide.streaming.run import finish, start

LATE = "2 hours"
BOUND = "6 hours"
# Batches that a table is dealt to.
PARTS = 3


def _parts(df, parts, order="seq"):
    """The rows in `parts` batches, in arrival order; every row is in one of them."""
    bounds = df.agg(F.min(order), F.max(order)).first()
    low, high = bounds[0] or 0, (bounds[1] or 0) + 1
    edges = [low + (high - low) * n // parts for n in range(parts + 1)]
    return [df.where((F.col(order) >= a) & (F.col(order) < b)) for a, b in zip(edges, edges[1:], strict=False)]


# Entities of a dictionary of any size


@query
def entity_mentions_indexed(spark, sf):
    """The usual dictionary as a table, through the index of q-grams."""
    dictionary = entities.entity_dictionary(spark)
    return entity_index.entity_mentions(_docs(spark, sf), dictionary).select("language", "id", "entity_type", "name")


ORACLES["entity_mentions_indexed"] = f"WITH {DOC_MENTIONS} SELECT language, id, entity_type, name FROM m"


@query
def entity_counts_large(spark, sf):
    """How many documents mention each word of the benchmark: a dictionary that is data."""
    words = tables.table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("name"))
    dictionary = words.where("name <> ''").distinct().select(
        F.lit("benchmark").alias("entity_type"), "name", F.lit(0).alias("entry")
    )
    return entity_index.entity_mention_counts(entity_index.entity_mentions(_docs(spark, sf), dictionary))


ORACLES["entity_counts_large"] = rf"""
WITH p AS (
  SELECT DISTINCT unnest(string_split_regex(lower(text), '\s+')) AS name FROM benchmark
),
d AS (SELECT lower(text) AS text FROM documents WHERE text <> '' AND lang IN ({TARGETS}))
SELECT 'benchmark' AS entity_type, name, count(*) AS documents
FROM d JOIN p ON name <> '' AND contains(d.text, p.name) GROUP BY name"""


# Pushes per closed window


@query
def stream_closed_counts(spark, sf):
    path = scratch_path(spark, "closed")
    stream = tables.event_stream(spark, sf)
    job = windows.maintain_closed_counts(stream, path, scratch_path(spark, "closed-checkpoint"), LATE, DAY, HALF_DAY)
    finish(job)
    return windows.closed_counts(spark, path).withColumns(as_text("batch_time"))


ORACLES["stream_closed_counts"] = f"""WITH {BATCHES}
SELECT {_stamp("batch_time")} AS batch_time, language, count(*) AS count FROM bu
WHERE batch_time - pushed_at <= INTERVAL 12 HOUR
  AND batch_time <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events)
GROUP BY bu.batch_time, language"""


# First versions with a bound


def _versions(df):
    return df.select("id", "seq", "language", "stargazers_count")


@query
def first_seen_within(spark, sf):
    return _versions(expiry.first_of_sessions(tables.events(spark, sf), BOUND))


@query
def stream_first_seen_within(spark, sf):
    """The sessions that have closed when the stream ends."""
    out = scratch_path(spark, "first-within")
    kept = expiry.first_seen_within(tables.event_stream(spark, sf), BOUND, LATE)
    writer = kept.writeStream.outputMode("append").format("parquet").option("path", out)
    finish(start(writer, scratch_path(spark, "first-within-checkpoint")))
    return _versions(spark.read.schema(kept.schema).parquet(out))


SESSIONS = f"""{EVENTS},
stepped AS (
  SELECT *, coalesce(pushed_at - lag(pushed_at) OVER (PARTITION BY id ORDER BY pushed_at, seq) > INTERVAL 6 HOUR, true) AS new
  FROM ev
),
numbered AS (
  SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY pushed_at, seq) AS session FROM stepped
),
closing AS (SELECT *, max(pushed_at) OVER (PARTITION BY id, session) + INTERVAL 6 HOUR AS closes FROM numbered)"""
ORACLES["first_seen_within"] = f"WITH {SESSIONS} SELECT id, seq, language, stargazers_count FROM closing WHERE new"
ORACLES["stream_first_seen_within"] = f"""WITH {SESSIONS}
SELECT id, seq, language, stargazers_count FROM closing
WHERE new AND closes <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events)"""


# Counts from the state of a query


def _state(spark, sf):
    checkpoint = scratch_path(spark, "state-checkpoint")
    finish(lifetime.maintain_state(tables.event_stream(spark, sf), checkpoint))
    return lifetime.state_totals(spark, checkpoint)


@query
def stream_state_counts(spark, sf):
    return counts.counts_of_totals(_state(spark, sf))


@query
def stream_state_averages(spark, sf):
    return counts.averages_of_totals(_state(spark, sf))


ORACLES["stream_state_counts"] = f"WITH {UNIQUE} SELECT language, count(*) AS count FROM uniq GROUP BY ALL"
ORACLES["stream_state_averages"] = f"""WITH {UNIQUE}
SELECT language, {_rounded("avg(stargazers_count)")} AS avg_stargazers_count FROM uniq GROUP BY language"""


# Term statistics and neighbours, batch by batch


def _folded_statistics(spark, sf):
    path = scratch_path(spark, "term-totals")
    for n, part in enumerate(_parts(tables.documents(spark, sf), PARTS)):
        terms.fold_terms(part, path, n, TEXT_LANGUAGES)
    return terms.statistics(spark, path)


@query
def vocab_topn_folded(spark, sf):
    vocab = vocabulary.vocabulary(_folded_statistics(spark, sf), 2)
    return vocab.select("language", "rank", "term", "corpus_count", "doc_count")


@query
def idf_weights_folded(spark, sf):
    statistics = _folded_statistics(spark, sf)
    idf = vocabulary.idf_weights(vocabulary.vocabulary(statistics, 1), vocabulary.docs_of_statistics(statistics))
    return idf.select("language", "term", "doc_count", F.round("idf", 6).alias("idf"))


ORACLES["vocab_topn_folded"] = f"WITH {_vocabulary(2)} SELECT language, rank, term, corpus_count, doc_count FROM vocab"
ORACLES["idf_weights_folded"] = f"WITH {_vocabulary(1)} SELECT language, term, doc_count, round(idf, 6) AS idf FROM idf"


@query
def band_candidates_folded(spark, sf):
    path = scratch_path(spark, "band")
    for n, part in enumerate(_parts(tables.documents(spark, sf), PARTS)):
        bands.fold_pairs(part, path, n, TEXT_LANGUAGES)
    return bands.pairs(spark, path)


ORACLES["band_candidates_folded"] = f"WITH {COSINE} SELECT language, id1, id2 FROM cand"


# History in few folders


@query
def sink_batch_history_tiered(spark, sf):
    """Ten batches of events, eight of which have been merged."""
    path = scratch_path(spark, "tiers")
    events = tables.events(spark, sf).select(*EVENT_SCHEMA.names)
    for n, part in enumerate(_parts(events, 10)):
        tiers.append(part, path, n)
    return tiers.read(spark, path, EVENT_SCHEMA).withColumns(as_text("pushed_at"))


ORACLES["sink_batch_history_tiered"] = EVENT_RECORDS


# Paged responses


@query
def stream_search_pages(spark, sf):
    """Documents as landed responses of 50 items, read back as a stream of pages."""
    inbox, out = scratch_path(spark, "pages"), scratch_path(spark, "page-items")
    items = tables.documents(spark, sf).withColumn("page", F.expr(f"id div {PAGE}")).drop("created_at", "seq")
    listed = F.collect_list(F.struct(*[c for c in items.columns if c != "page"])).alias("items")
    payload = F.to_json(F.struct("items")).alias("payload")
    pages.land_pages(items.groupBy("page").agg(listed).select("page", payload), inbox)
    found = search.project_repo_fields(
        search.search_items(pages.stream_pages(spark, inbox), search.ITEM_SCHEMA),
        ("id", "name", "language", "description", "stargazers_count"),
    )
    finish(start(found.writeStream.format("parquet").option("path", out), scratch_path(spark, "pages-checkpoint")))
    return spark.read.schema(found.schema).parquet(out)


ORACLES["stream_search_pages"] = DOCUMENT_FIELDS


# Text sections of the payload, and topics as shown, on input that SQL can make


@query
def snapshot_text_rows(spark, sf):
    """Entities, pairs and trends of a published snapshot as flat rows of text."""
    repos = tables.documents(spark, sf)
    sections = {
        "req6": report.entity_section(repos, TEXT_LANGUAGES),
        "req7": similarity.similar_pairs(repos, TEXT_LANGUAGES),
        "req8": report.trend_section(repos, AS_OF, TEXT_LANGUAGES),
    }
    path = scratch_path(spark, "text-snapshot")
    snapshots.publish_snapshot(report.snapshot_payload(sections), path, 0)
    latest = snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path), required=())

    def listed(section, shape):
        content = latest.where(F.col("section") == section).select("section", F.from_json("content", f"array<struct<{shape}>>").alias("c"))
        return content.select("section", F.inline("c"))

    entity = "array<struct<name string, count long>>"
    found = listed("req6", f"language string, entities map<string, {entity}>")
    found = found.select("section", "language", F.explode("entities").alias("kind", "e")).select("section", "language", "kind", F.inline("e"))
    entities_flat = found.select("section", "language", F.concat_ws(":", "kind", "name").alias("item"), F.col("count").cast("string").alias("value"))
    pair = "array<struct<repo1 string, repo2 string, similarity decimal(10,3)>>"
    pairs = listed("req7", f"language string, similar_pairs {pair}, total_repos_analyzed long")
    total = pairs.select("section", "language", F.lit("analyzed").alias("item"), F.col("total_repos_analyzed").cast("string").alias("value"))
    pairs_flat = pairs.select("section", "language", F.inline("similar_pairs")).select(
        "section", "language", F.concat_ws(" ", "repo1", "repo2").alias("item"), F.col("similarity").cast("string").alias("value")
    )
    month = "struct<month string, repo_count long, total_stars long, growth_rate decimal(20,2)>"
    trend = listed("req8", f"language string, trend_direction string, total_months long, monthly_data array<{month}>, peak_month {month}")
    shown = lambda m: F.concat_ws(" ", m["repo_count"].cast("string"), m["total_stars"].cast("string"), m["growth_rate"].cast("string"))
    months = trend.select("section", "language", F.explode("monthly_data").alias("m")).select(
        "section", "language", F.col("m.month").alias("item"), shown(F.col("m")).alias("value")
    )
    peak = trend.select("section", "language", F.lit("peak").alias("item"), F.col("peak_month.month").alias("value"))
    direction = trend.select(
        "section", "language", F.lit("direction").alias("item"), F.concat_ws(" ", "trend_direction", F.col("total_months").cast("string")).alias("value")
    )
    out = entities_flat
    for part in (total, pairs_flat, months, peak, direction):
        out = out.unionByName(part)
    return out


MADE_TREND = TREND.replace("FROM orders GROUP BY ALL", "FROM made GROUP BY ALL")
ORACLES["snapshot_text_rows"] = f"""
WITH {DOC_MENTIONS},
{COSINE},
made AS (
  SELECT lang AS o_orderpriority, n_chars AS o_totalprice,
         TIMESTAMP '2024-07-01 00:00:00' - to_days(CAST(
           30 * ((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 6) AS INTEGER)) AS o_orderdate
  FROM documents WHERE lang IN ({TARGETS})
),
{MADE_TREND}
SELECT 'req6' AS section, language, entity_type || ':' || name AS item, CAST(count AS VARCHAR) AS value FROM mtop
UNION ALL SELECT 'req7', language, 'analyzed', CAST(docs AS VARCHAR) FROM nd WHERE docs >= 3
UNION ALL SELECT 'req7', language, repo1 || ' ' || repo2, CAST(CAST(similarity AS DECIMAL(10, 3)) AS VARCHAR) FROM named
UNION ALL SELECT 'req8', language, month,
  repo_count || ' ' || CAST(total_stars AS BIGINT) || ' ' || CAST(CAST(growth_rate AS DECIMAL(20, 2)) AS VARCHAR)
  FROM numbered WHERE back <= 6
UNION ALL SELECT 'req8', language, 'peak', month FROM peak
UNION ALL SELECT 'req8', language, 'direction', trend_direction || ' ' || total_months FROM direction"""


def _dealt_topics(spark, sf):
    """Topics dealt from the vocabulary: of each language, every fifth word by rank."""
    statistics = vocabulary.term_statistics(_docs(spark, sf))
    vocab = vocabulary.vocabulary(statistics, 2).where(F.col("rank") <= TOPICS * TOPIC_WORDS)
    return vocab.select(
        "language",
        ((F.col("rank") - 1) % TOPICS).alias("topic_id"),
        (F.floor((F.col("rank") - 1) / TOPICS) + 1).cast("int").alias("rank"),
        F.col("term").alias("word"),
        (F.lit(1.0) / F.col("rank")).alias("weight"),
    )


@query
def topic_display_dealt(spark, sf):
    return display.topic_display(topics.topics_nested(_dealt_topics(spark, sf)))


@query
def topic_lines_dealt(spark, sf):
    return display.topic_lines(topics.topics_nested(_dealt_topics(spark, sf)))


def _dealt(shown):
    return f"""WITH {_vocabulary(2)},
dealt AS (
  SELECT language, CAST((rank - 1) % 5 AS INTEGER) AS topic_id, (rank - 1) // 5 + 1 AS place, term
  FROM vocab WHERE rank <= 25
),
shown AS (
  SELECT language, topic_id, string_agg(term, ', ' ORDER BY place) AS words FROM dealt WHERE place <= {shown} GROUP BY ALL
)"""


ORACLES["topic_display_dealt"] = f"{_dealt(3)} SELECT language, topic_id + 1 AS topic_number, words AS formatted_words FROM shown"
ORACLES["topic_lines_dealt"] = f"{_dealt(5)} SELECT language, 'Topic ' || topic_id || ': ' || words AS line FROM shown"
