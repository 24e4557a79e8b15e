"""The eight results in one JSON payload."""

from pyspark.sql import functions as F

from repotide.contract import ENTITIES, LANGUAGES
from repotide.operators import counts, entities, similarity, topics, trends, vocabulary, words
from repotide.scratch import write_table


def count_sections(repos, languages=LANGUAGES, totals=None):
    """req1 and req3 of unique repositories, as columns `count` and `avg_stargazers_count`."""
    if totals is None:
        numbers = counts.total_count_by_language(repos)
        averages = counts.avg_stars_by_language(repos)
    else:
        numbers = counts.counts_of_totals(totals)
        averages = counts.averages_of_totals(totals)
    return {
        "req1": counts.zero_fill_when_empty(numbers, "count", languages),
        "req3": counts.zero_fill_when_empty(averages, "avg_stargazers_count", languages),
    }


def word_section(repos, languages=LANGUAGES, word_counts=None):
    """req4: top words per language; without any repository each target with an empty list."""
    word_counts = words.word_counts(repos) if word_counts is None else word_counts
    nested = words.top_words_nested(words.top_words_of_counts(word_counts))
    empty = counts.small_table(repos.sparkSession, languages, "language").where(~repos.exists())
    nothing = F.array().cast(nested.schema["top_ten_words"].dataType)
    return nested.unionByName(empty.withColumn("top_ten_words", nothing))


def topic_section(repos, languages=LANGUAGES, term_statistics=None):
    nested = topics.topics_nested(topics.lda_topics(repos, languages, statistics=term_statistics))
    listed = F.array_sort(F.collect_list(F.struct("topic_id", "top_words", "word_weights")))
    return nested.groupBy("language").agg(listed.alias("topics"))


def entity_section(repos, languages=LANGUAGES, dictionary=ENTITIES, entity_counts=None):
    if entity_counts is None:
        docs = vocabulary.text_eligible(repos, languages)
        entity_counts = entities.entity_counts(entities.entity_mentions(docs, dictionary))
    top = entities.top_entities(entity_counts)
    grid = entities.entity_grid(top, languages, dictionary)
    by_type = [
        F.first(F.when(F.col("entity_type") == t, F.col("entities")), ignorenulls=True).alias(t)
        for t in dictionary
    ]
    return grid.groupBy("language").agg(*by_type).select(
        "language", F.struct(*dictionary).alias("entities")
    )


def trend_section(repos, as_of, languages=LANGUAGES, months=None):
    """req8 over real creation dates, and demonstration dates where a language has none.

    `months` are the months of the dated rows, if kept up to date elsewhere. Then the repositories
    are only read for languages that have no dated row at all.
    """
    if months is None:
        months = trends.monthly_rollup(trends.dated_rows(repos, languages))
        dated = trends.dated_rows(repos, languages).select("language").distinct()
    else:
        dated = months.select("language").distinct()
    made = trends.monthly_rollup(trends.synthetic_dates(repos, as_of, languages, dated=dated))
    return trends.trend_report(trends.trend_of_months(months.unionByName(made)))


def recent_section(history):
    """req2 in time order, with the time itself and the label that is shown."""
    return history.select(
        "batch_time", "language", "count", F.date_format("batch_time", "HH:mm:ss").alias("batch_label")
    )


def all_sections(
    repos,
    history,
    as_of,
    languages=LANGUAGES,
    language_totals=None,
    word_counts=None,
    entity_counts=None,
    term_statistics=None,
    months=None,
):
    """The eight results. `repos` are unique; `history` has batch_time, language, count.

    Running totals, if given, save a pass over all repositories each. Topics and similarity share
    one count of the terms.
    """
    if term_statistics is None:
        counted = vocabulary.term_statistics(vocabulary.text_eligible(repos, languages))
        term_statistics = write_table(counted, "term-statistics")
    return {
        **count_sections(repos, languages, language_totals),
        "req2": recent_section(history),
        "req4": word_section(repos, languages, word_counts),
        "req5": topic_section(repos, languages, term_statistics),
        "req6": entity_section(repos, languages, entity_counts=entity_counts),
        "req7": similarity.similar_pairs(repos, languages, statistics=term_statistics),
        "req8": trend_section(repos, as_of, languages, months),
    }


def snapshot_payload(sections):
    """One row with one JSON object; each section is a list in row order.

    The sections are reports of a few rows per language (and batch), not data, so a list of
    each fits in one row.
    """
    spark = next(iter(sections.values())).sparkSession
    lists = [
        section.agg(F.array_sort(F.collect_list(F.struct(*section.columns))))
        .scalar()
        .alias(name)
        for name, section in sorted(sections.items())
    ]
    return spark.range(1).select(F.to_json(F.struct(*lists)).alias("payload"))
