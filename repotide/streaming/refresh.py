"""Publish the results after each micro-batch of new repositories.

Counts of repositories, words, entities, terms and months only ever grow by those of the new
repositories, so they are folded into running totals and cost a pass over the new rows. Weights
depend on all texts, so topics and similarity read the lifetime table once to make vectors; what
they need to know about its terms comes from the totals.
"""

from datetime import timedelta

from pyspark.sql import functions as F

from repotide.contract import LANGUAGES, RECENT_PUSH_AGE
from repotide.operators import entities, trends, vocabulary, words
from repotide.plans.report import all_sections, snapshot_payload
from repotide.scratch import read_existing, temporary, write_table
from repotide.sources import snapshots
from repotide.streaming import recent, terms
from repotide.streaming.lifetime import fold_language_totals, language_totals
from repotide.streaming.run import start

WORD_TOTALS = (["language", "word"], ["count"])
ENTITY_TOTALS = (["language", "entity_type", "name", "entry"], ["count"], ["first_seq"])
MONTH_TOTALS = (["language", "month"], ["repo_count", "total_stars"])
MONTHS = "language string, month string, repo_count long, total_stars long"
# The payload lists the recent pushes of this many hours; the table keeps all batches.
HISTORY_HOURS = 24


def fold_counts(new, totals, version, languages=LANGUAGES):
    """Add `new` repositories to the running counts of languages, words, terms, entities and months."""
    fold_language_totals(new, f"{totals}/languages", version)
    snapshots.add_to_totals(words.word_counts(new), f"{totals}/words", version, *WORD_TOTALS)
    mentions = entities.entity_mentions(vocabulary.text_eligible(new, languages))
    found = entities.entity_counts(mentions)
    snapshots.add_to_totals(found, f"{totals}/entities", version, *ENTITY_TOTALS)
    terms.fold_terms(new, f"{totals}/terms", version, languages)
    months = trends.monthly_rollup(trends.dated_rows(new, languages))
    snapshots.add_to_totals(months, f"{totals}/months", version, *MONTH_TOTALS)


def month_totals(spark, totals):
    """(language, month, repo_count, total_stars) of the dated repositories so far."""
    months = snapshots.read_totals(spark, f"{totals}/months", *MONTH_TOTALS)
    return spark.createDataFrame([], MONTHS) if months is None else months


def refresh(
    spark, repos, pushes, totals, snapshot, languages=LANGUAGES, as_of=None, hours=HISTORY_HOURS, max_age=RECENT_PUSH_AGE
):
    """Publish the payload as the next version; the tables are given by path. `as_of` dates
    undated languages. Scratch tables of the refresh are deleted."""
    unique = read_existing(spark, repos)
    if unique is None:
        return
    newest = recent.pushes(spark, pushes).agg(F.max("batch_time")).first()[0]
    since = newest and newest - timedelta(hours=hours)
    history = recent.recent_history(spark, pushes, languages, max_age, since)
    as_of = as_of or spark.range(1).select(F.current_timestamp()).first()[0]
    with temporary(spark):
        # Read for vocabulary, document counts and both results that need weights.
        statistics = write_table(terms.statistics(spark, f"{totals}/terms"), "term-statistics")
        sections = all_sections(
            unique.drop("batch_id"),
            history,
            as_of,
            languages,
            language_totals=language_totals(spark, f"{totals}/languages"),
            word_counts=snapshots.read_totals(spark, f"{totals}/words", *WORD_TOTALS),
            entity_counts=snapshots.read_totals(spark, f"{totals}/entities", *ENTITY_TOTALS),
            term_statistics=statistics,
            months=month_totals(spark, totals),
        )
        version = snapshots.next_version(spark, snapshot)
        snapshots.publish_snapshot(snapshot_payload(sections), snapshot, version)


def console(df, checkpoint, interval=None):
    """Print each micro-batch of a stream."""
    return start(df.writeStream.format("console").option("truncate", "false"), checkpoint, interval)
