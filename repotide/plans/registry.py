"""One query per operator over the test tables: name -> (spark, sf_dir) -> DataFrame.

Results are flat and timestamps are text where that makes them easy to compare with SQL.
"""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.contract import LANGUAGES, REPO_SCHEMA
from repotide.operators import (
    counts,
    display,
    entities,
    similarity,
    state,
    topics,
    trends,
    vocabulary,
    words,
)
from repotide.plans import report, tables
from repotide.plans.tables import EVENT_LANGUAGES, PRIORITIES, TEXT_LANGUAGES
from repotide.scratch import scratch_path, write_table
from repotide.sources import ndjson, search, snapshots
from repotide.streaming import landing, lifetime, recent, refresh
from repotide.streaming.run import finish, start

DAY = "1 day"
HALF_DAY = "12 hours"
AS_OF = datetime(2024, 7, 1)
PAGE = 50
PART_WORDS = {
    "finish": ("hot", "cold", "red", "blue", "old", "new", "small", "large"),
    "item": ("ring", "bolt", "rod", "gear", "anvil", "plate", "widget", "gizmo"),
}


QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _schema(*names):
    return T.StructType([f for f in REPO_SCHEMA if f.name in names])


EVENT_SCHEMA = _schema("id", "language", "stargazers_count", "pushed_at", "seq")
TEXT_SCHEMA = _schema("id", "name", "language", "description", "stargazers_count", "created_at", "seq")


def as_text(*names, pattern="yyyy-MM-dd HH:mm:ss"):
    return {n: F.date_format(n, pattern) for n in names}


# Sources, parsing, sinks


def _event_lines(spark, sf):
    return ndjson.to_lines(tables.events(spark, sf).select(*EVENT_SCHEMA.names))


def _landed_lines(spark, lines, label):
    """A folder of line files, as a producer would leave them."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


def _land(spark, lines, schema, label):
    """Land lines through the streaming job; the table path and the finished query."""
    source = ndjson.stream_lines(spark, path=_landed_lines(spark, lines, f"{label}-lines"))
    table = scratch_path(spark, f"{label}-landed")
    job = landing.land(source, table, scratch_path(spark, f"{label}-checkpoint"), schema)
    return table, finish(job)


@query
def stream_ndjson_source(spark, sf):
    path = _landed_lines(spark, _event_lines(spark, sf), "ndjson")
    out = scratch_path(spark, "ndjson-read")
    lines = ndjson.stream_lines(spark, path=path)
    writer = lines.writeStream.format("parquet").option("path", out)
    finish(start(writer, scratch_path(spark, "ndjson-checkpoint")))
    read = spark.read.schema("value string").parquet(out)
    records = ndjson.good_rows(ndjson.parse_lines(read, EVENT_SCHEMA))
    return records.withColumns(as_text("pushed_at"))


def _mixed_lines(spark, sf):
    """Every event as a JSON line, and every document text as a line that is no JSON."""
    texts = tables.table(spark, sf, "documents").select(F.col("text").alias("value"))
    return _event_lines(spark, sf).unionByName(texts)


@query
def parse_repo_json(spark, sf):
    parsed = ndjson.parse_lines(_mixed_lines(spark, sf), EVENT_SCHEMA)
    return ndjson.good_rows(parsed).withColumns(as_text("pushed_at"))


@query
def quarantine_bad_rows(spark, sf):
    return ndjson.quarantined_lines(ndjson.parse_lines(_mixed_lines(spark, sf), EVENT_SCHEMA))


def _pages(rows, *page):
    """Responses of at most PAGE items each."""
    items = F.collect_list(F.struct(*rows.columns)).alias("items")
    return rows.groupBy(*page).agg(items).select(F.to_json(F.struct("items")).alias("payload"))


@query
def flatten_search_items(spark, sf):
    turns = tables.table(spark, sf, "conversations")
    pages = _pages(turns, "conv_id", F.expr(f"turn div {PAGE}"))
    return search.search_items(pages, turns.schema)


def _document_items(spark, sf):
    items = tables.documents(spark, sf).withColumn("fork", F.lit(False))
    pages = _pages(items.drop("created_at", "seq"), F.expr(f"id div {PAGE}"))
    return search.search_items(pages, search.ITEM_SCHEMA)


@query
def source_language_filter(spark, sf):
    items = search.source_language_filter(_document_items(spark, sf), ("en", "fr", "de"))
    return items.select("id", "language")


@query
def project_repo_fields(spark, sf):
    fields = ("id", "name", "language", "description", "stargazers_count")
    return search.project_repo_fields(_document_items(spark, sf), fields)


@query
def emit_ndjson(spark, sf):
    return _event_lines(spark, sf)


@query
def sink_batch_history(spark, sf):
    table, _ = _land(spark, _event_lines(spark, sf), EVENT_SCHEMA, "history")
    history = landing.batch_history(landing.landed(spark, table, EVENT_SCHEMA))
    return history.select(*EVENT_SCHEMA.names).withColumns(as_text("pushed_at"))


@query
def stream_batch_metrics(spark, sf):
    lines = _mixed_lines(spark, sf)
    table, _ = _land(spark, lines, EVENT_SCHEMA, "metrics")
    return landing.batch_metrics(landing.landed(spark, table, EVENT_SCHEMA))


@query
def batch_metrics(spark, sf):
    metrics = counts.batch_metrics(_batched(spark, sf), DAY)
    return metrics.withColumns(as_text("batch_time"))


@query
def snapshot_payload(spark, sf):
    repos = tables.documents(spark, sf)
    history = counts.recent_push_history(_batch_unique(spark, sf), HALF_DAY, EVENT_LANGUAGES)
    return report.snapshot_payload(report.all_sections(repos, history, AS_OF, TEXT_LANGUAGES))


def _small_payload(spark, sf):
    repos = tables.documents(spark, sf)
    history = counts.recent_push_history(_batch_unique(spark, sf), HALF_DAY, EVENT_LANGUAGES)
    sections = report.count_sections(repos, TEXT_LANGUAGES)
    sections["req2"] = report.recent_section(history)
    sections["req4"] = report.word_section(repos, TEXT_LANGUAGES)
    return report.snapshot_payload(sections)


@query
def snapshot_sink_latest(spark, sf):
    path = scratch_path(spark, "snapshot")
    payload = write_table(_small_payload(spark, sf), "payload")
    for version in range(3):
        snapshots.publish_snapshot(payload, path, version)
    return snapshots.read_latest(spark, path).select("version", "payload")


@query
def snapshot_read_latest(spark, sf):
    path = scratch_path(spark, "snapshot")
    snapshots.publish_snapshot(_small_payload(spark, sf), path, 0)
    return snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path))


@query
def snapshot_rows(spark, sf):
    """The counts, pushes, averages and words of a published snapshot as flat rows of text."""
    path = scratch_path(spark, "snapshot")
    for version in range(2):
        snapshots.publish_snapshot(_small_payload(spark, sf), path, version)
    sections = snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path))

    def rows(section, shape, item, value):
        listed = sections.where(F.col("section") == section)
        flat = listed.select("section", F.inline(F.from_json("content", f"array<struct<{shape}>>")))
        return flat.select("section", "language", item.alias("item"), value.cast("string").alias("value"))

    none = F.lit(None).cast("string")
    words_shape = "language string, top_ten_words array<struct<word string, count long>>"
    nested = rows("req4", words_shape, none, F.to_json("top_ten_words"))
    parts = [
        rows("req1", "language string, count long", none, F.col("count")),
        rows("req2", "batch_label string, language string, count long", F.col("batch_label"), F.col("count")),
        rows("req3", "language string, avg_stargazers_count decimal(20,2)", none, F.col("avg_stargazers_count")),
        nested,
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# State, dedup and batching


def _batched(spark, sf):
    return state.assign_batch(tables.events(spark, sf), DAY)


def _batch_unique(spark, sf):
    return state.dedup_within_batch(_batched(spark, sf))


def _unique_events(spark, sf):
    return state.dedup_first_seen(tables.events(spark, sf))


@query
def dedup_first_seen(spark, sf):
    return _unique_events(spark, sf).withColumns(as_text("pushed_at"))


@query
def dedup_within_batch(spark, sf):
    return _batch_unique(spark, sf).withColumns(as_text("pushed_at", "batch_time"))


@query
def assign_batch(spark, sf):
    batched = _batched(spark, sf).select("seq", "id", "batch_time")
    return batched.withColumns(as_text("batch_time"))


def _stream_totals(spark, sf):
    path = scratch_path(spark, "totals")
    stream = tables.event_stream(spark, sf)
    finish(lifetime.maintain_totals(stream, path, scratch_path(spark, "totals-checkpoint")))
    return path


@query
def stream_lifetime_counts(spark, sf):
    return lifetime.lifetime_counts(spark, _stream_totals(spark, sf))


@query
def stream_avg_stars(spark, sf):
    return lifetime.lifetime_averages(spark, _stream_totals(spark, sf))


@query
def stream_recent_counts(spark, sf):
    path = scratch_path(spark, "pushes")
    stream = recent.replayed(tables.event_stream(spark, sf), DAY)
    finish(recent.maintain_pushes(stream, path, scratch_path(spark, "pushes-checkpoint")))
    return recent.recent_counts(spark, path, HALF_DAY).withColumns(as_text("batch_time"))


def _date_files(spark, folder):
    """Give the files of a sorted output times in the order of their names, as if a producer had
    written one after the other. Only the listing goes through the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(status.getPath().toString() for status in files.listStatus(path))
    for n, name in enumerate(names):
        files.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 1000 * n, -1)


@query
def arrival_order(spark, sf):
    """Events whose lines carry no sequence number: the first to arrive wins, whenever pushed."""
    lines = ndjson.to_lines(tables.events(spark, sf).drop("seq").orderBy("pushed_at", F.desc("id")))
    inbox = _landed_lines(spark, lines, "arrival-lines")
    _date_files(spark, inbox)
    source = ndjson.stream_lines(spark, path=inbox)
    table = scratch_path(spark, "arrival-landed")
    finish(landing.land(source, table, scratch_path(spark, "arrival-checkpoint"), EVENT_SCHEMA))
    landed = landing.landed(spark, table, EVENT_SCHEMA)
    return state.dedup_first_seen(landed.drop("line", "bad", "batch", "batch_time")).select(
        "id", F.date_format("pushed_at", "yyyy-MM-dd HH:mm:ss").alias("pushed_at")
    )


@query
def stream_text_refresh(spark, sf):
    lines = ndjson.to_lines(tables.documents(spark, sf).select(*TEXT_SCHEMA.names))
    table, _ = _land(spark, lines, TEXT_SCHEMA, "refresh")
    path = {
        name: scratch_path(spark, f"refresh-{name}")
        for name in ("index", "repos", "pushes", "totals", "latest", "pushed", "checkpoint")
    }
    pushes = recent.replayed(tables.event_stream(spark, sf), DAY)
    finish(recent.maintain_pushes(pushes, path["pushes"], path["pushed"]))

    def publish(new, batch_id):
        refresh.fold_counts(new, path["totals"], batch_id, TEXT_LANGUAGES)
        refresh.refresh(
            spark, path["repos"], path["pushes"], path["totals"], path["latest"], TEXT_LANGUAGES, AS_OF
        )

    finish(
        lifetime.maintain_repos(
            spark,
            table,
            path["index"],
            path["repos"],
            path["checkpoint"],
            schema=TEXT_SCHEMA,
            after=publish,
        )
    )
    return snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path["latest"]))


# Counting and averaging


@query
def available_languages(spark, sf):
    return counts.available_languages(_unique_events(spark, sf))


@query
def total_count_by_language(spark, sf):
    return counts.total_count_by_language(_unique_events(spark, sf))


@query
def zero_fill_languages(spark, sf):
    """`fork` is a target without any row, so each batch gets a 0 for it."""
    targets = (*EVENT_LANGUAGES, "fork")
    filled = counts.recent_push_history(_batch_unique(spark, sf), "1 hour", targets)
    return filled.drop("batch_label").withColumns(as_text("batch_time"))


@query
def zero_fill_when_empty(spark, sf):
    """No document is in a default target language, so each of them gets a 0."""
    targets = tables.documents(spark, sf).where(F.col("language").isin(*LANGUAGES))
    return counts.zero_fill_when_empty(counts.total_count_by_language(targets), "count")


@query
def zero_fill_when_present(spark, sf):
    """With any row at all nothing is filled, not even for a target that has none."""
    found = counts.total_count_by_language(tables.documents(spark, sf))
    return counts.zero_fill_when_empty(found, "count", (*TEXT_LANGUAGES, "none"))


@query
def recent_push_counts(spark, sf):
    pushes = counts.recent_push_counts(_batch_unique(spark, sf), HALF_DAY)
    return pushes.withColumns(as_text("batch_time"))


@query
def recent_push_history(spark, sf):
    history = counts.recent_push_history(_batch_unique(spark, sf), HALF_DAY, EVENT_LANGUAGES)
    return history.withColumns(as_text("batch_time"))


@query
def avg_stars_by_language(spark, sf):
    return counts.avg_stars_by_language(tables.documents(spark, sf))


# Word frequency


@query
def clean_words(spark, sf):
    cleaned = words.clean_words("description")
    docs = tables.documents(spark, sf).select("id", "language", cleaned.alias("w"))
    return docs.select("id", "language", F.size("w").alias("n_words"), F.array_join("w", " ").alias("words"))


@query
def word_counts(spark, sf):
    return words.word_counts(tables.documents(spark, sf))


@query
def top10_words(spark, sf):
    return words.top_words(tables.documents(spark, sf))


@query
def top_words_nested(spark, sf):
    """The lists as JSON text, which compares in any engine."""
    nested = words.top_words_nested(words.top_words(tables.documents(spark, sf)))
    return nested.withColumn("top_ten_words", F.to_json("top_ten_words"))


# Terms, vocabulary, weights


def _docs(spark, sf):
    return vocabulary.text_eligible(tables.documents(spark, sf), TEXT_LANGUAGES)


def _vocabulary(statistics, min_df=1):
    return vocabulary.vocabulary(statistics, min_df)


@query
def text_eligible(spark, sf):
    docs = vocabulary.text_eligible(tables.documents(spark, sf), ("en", "fr"))
    return docs.select("id", "language")


@query
def min_docs_gate(spark, sf):
    return vocabulary.min_docs_gate(_docs(spark, sf), 150).select("id", "language")


def _tokens(docs):
    return docs.select(
        "id", "language", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


@query
def ml_tokens(spark, sf):
    return _tokens(vocabulary.tokens(_docs(spark, sf)))


@query
def stopword_filter(spark, sf):
    return _tokens(vocabulary.filtered_tokens(_docs(spark, sf)))


@query
def vocab_topn(spark, sf):
    vocab = _vocabulary(vocabulary.term_statistics(_docs(spark, sf)), min_df=2)
    return vocab.select("language", "rank", "term", "corpus_count", "doc_count")


@query
def term_frequency(spark, sf):
    docs = _docs(spark, sf)
    vocab = _vocabulary(vocabulary.term_statistics(docs))
    return vocabulary.vocabulary_frequencies(docs, vocab)


def _idf(docs):
    statistics = vocabulary.term_statistics(docs)
    return vocabulary.idf_weights(_vocabulary(statistics), vocabulary.docs_of_statistics(statistics))


@query
def idf_weights(spark, sf):
    idf = _idf(_docs(spark, sf))
    return idf.select("language", "term", "doc_count", F.round("idf", 6).alias("idf"))


@query
def tfidf_vectors(spark, sf):
    docs = _docs(spark, sf)
    weights = vocabulary.tfidf_weights(docs, _idf(docs))
    return weights.select("language", "id", "term", "tf", F.round("weight", 6).alias("weight"))


# Topics


def _topics(spark, sf):
    return topics.lda_topics(tables.documents(spark, sf), TEXT_LANGUAGES)


@query
def lda_topics(spark, sf):
    return topics.topics_nested(_topics(spark, sf))


@query
def topic_top_words(spark, sf):
    return _topics(spark, sf)


@query
def lda_failure_isolation(spark, sf):
    statistics = vocabulary.term_statistics(_docs(spark, sf))
    return topics.topic_readiness(statistics, min_docs=150)


@query
def topic_display(spark, sf):
    return display.topic_display(topics.topics_nested(_topics(spark, sf)))


@query
def topic_lines(spark, sf):
    return display.topic_lines(topics.topics_nested(_topics(spark, sf)))


# Entities


def _mentions(spark, sf):
    return entities.entity_mentions(_docs(spark, sf))


def _top_entities(spark, sf):
    return entities.top_entities(entities.entity_counts(_mentions(spark, sf)))


@query
def entity_dictionary(spark, sf):
    """Each dictionary entry with the number of documents that mention it."""
    entries = entities.entity_dictionary(spark)
    mentioned = entities.entity_counts(_mentions(spark, sf)).groupBy("entity_type", "name").agg(
        F.sum("count").alias("documents")
    )
    return entries.join(mentioned, ["entity_type", "name"], "left").select(
        "entity_type", "entry", "name", F.coalesce("documents", F.lit(0)).alias("documents")
    )


@query
def entity_mentions(spark, sf):
    return _mentions(spark, sf).select("language", "id", "entity_type", "name")


@query
def entity_mentions_parts(spark, sf):
    mentions = entities.entity_mentions(tables.parts(spark, sf), PART_WORDS)
    return mentions.select("language", "id", "entity_type", "name")


@query
def entity_top5(spark, sf):
    return _top_entities(spark, sf)


@query
def entity_top5_parts(spark, sf):
    mentions = entities.entity_mentions(tables.parts(spark, sf), PART_WORDS)
    return entities.top_entities(entities.entity_counts(mentions))


@query
def entity_grid(spark, sf):
    grid = entities.entity_grid(_top_entities(spark, sf), TEXT_LANGUAGES)
    return grid.select("language", "entity_type", F.size("entities").alias("found"))


@query
def entity_display(spark, sf):
    return display.entity_display(entities.entity_grid(_top_entities(spark, sf), TEXT_LANGUAGES))


# Similarity


@query
def band_candidates(spark, sf):
    return similarity.band_candidates(_docs(spark, sf))


@query
def cosine_banded(spark, sf):
    pairs = similarity.cosine_banded(_docs(spark, sf), languages=TEXT_LANGUAGES)
    return pairs.select("language", "id1", "id2", "similarity")


def _similar(spark, sf):
    return similarity.similar_pairs(tables.documents(spark, sf), TEXT_LANGUAGES)


@query
def similar_pairs_top5(spark, sf):
    return similarity.flat_pairs(_similar(spark, sf))


@query
def similarity_display(spark, sf):
    text = F.transform(
        "similar_pairs",
        lambda p: F.concat_ws(" ", p["repo1"], p["repo2"], p["similarity"].cast("string")),
    )
    shown = display.similarity_display(_similar(spark, sf))
    return shown.select("language", F.array_join(text, "; ").alias("pairs"), "total_repos_analyzed")


@query
def pair_lines(spark, sf):
    return display.pair_lines(similarity.flat_pairs(_similar(spark, sf)))


# Trends


def _dated(spark, sf):
    return trends.dated_rows(tables.orders(spark, sf), PRIORITIES)


def _trend(spark, sf):
    trend = trends.monthly_trend(_dated(spark, sf))
    return trend.withColumn("total_stars", F.col("total_stars").cast("double"))


@query
def created_at_rows(spark, sf):
    rows = trends.dated_rows(tables.orders(spark, sf), PRIORITIES[:3])
    return rows.select("id", "language", F.date_format("created_at", "yyyy-MM-dd").alias("created_at"))


@query
def synthetic_created_at(spark, sf):
    rows = trends.synthetic_dates(tables.documents(spark, sf), AS_OF, TEXT_LANGUAGES)
    return rows.select("id", "language", F.date_format("created_at", "yyyy-MM-dd").alias("created_at"))


@query
def monthly_rollup(spark, sf):
    rollup = trends.monthly_rollup(_dated(spark, sf))
    return rollup.withColumn("total_stars", F.col("total_stars").cast("double"))


@query
def monthly_avg_stars(spark, sf):
    rollup = trends.monthly_avg_stars(trends.monthly_rollup(_dated(spark, sf)))
    return rollup.select("language", "month", "avg_stars")


@query
def monthly_growth(spark, sf):
    return _trend(spark, sf).select("language", "month", "repo_count", "growth_rate")


@query
def trend_direction(spark, sf):
    return trends.trend_direction(_trend(spark, sf))


@query
def last_6_months(spark, sf):
    return trends.last_months(_trend(spark, sf))


@query
def peak_month(spark, sf):
    return trends.peak_month(_trend(spark, sf))


@query
def trend_display(spark, sf):
    return display.trend_display(trends.trend_direction(_trend(spark, sf)))


@query
def growth_arrow(spark, sf):
    months = _trend(spark, sf).select("language", "month", "growth_rate")
    return display.growth_arrow(months)


@query
def trend_lines(spark, sf):
    return display.trend_lines(trends.trend_report(_trend(spark, sf)))


# Result shaping of counts and words


@query
def activity_series_pivot(spark, sf):
    history = counts.recent_push_history(_batch_unique(spark, sf), HALF_DAY, EVENT_LANGUAGES)
    return display.activity_series(history, EVENT_LANGUAGES).withColumns(as_text("batch_time"))


@query
def avg_stars_series(spark, sf):
    averages = counts.avg_stars_by_language(tables.documents(spark, sf))
    series = display.aligned_series(averages, "avg_stargazers_count")
    zipped = F.arrays_zip("languages", "values")
    return series.select(F.posexplode(zipped).alias("position", "e")).select(
        "position", F.col("e.languages").alias("language"), F.col("e.values").alias("value")
    )


def _nested_words(spark, sf):
    return words.top_words_nested(words.top_words(tables.documents(spark, sf)))


@query
def word_lines(spark, sf):
    return display.word_lines(_nested_words(spark, sf))


@query
def sample_count_lines(spark, sf):
    repos = tables.documents(spark, sf)
    return display.sample_count_lines(
        counts.total_count_by_language(repos), counts.avg_stars_by_language(repos)
    )


@query
def sample_word_lines(spark, sf):
    return display.sample_word_lines(_nested_words(spark, sf))


@query
def sample_output_lines(spark, sf):
    """The saved-output format: count lines, then word lines."""
    return sample_count_lines(spark, sf).unionByName(sample_word_lines(spark, sf))


@query
def console_summary_lines(spark, sf):
    """One text line per result: similar pairs and trends."""
    return pair_lines(spark, sf).unionByName(trend_lines(spark, sf))
