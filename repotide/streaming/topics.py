"""Topics kept up to date batch by batch, from folded term statistics and a warm start."""

from pyspark.sql import functions as F

from repotide.contract import LANGUAGES, STOP_WORDS, TOPIC_MIN_DF, TOPIC_MIN_DOCS, TOPIC_WORDS, TOPICS, VOCABULARY_SIZE
from repotide.operators import online_topics
from repotide.operators.vocabulary import counted_terms, docs_of_statistics, text_eligible, vocabulary
from repotide.scratch import temporary, write_table
from repotide.sources import snapshots
from repotide.streaming import terms


def fold_topics(
    new,
    path,
    version,
    languages=LANGUAGES,
    k=TOPICS,
    min_docs=TOPIC_MIN_DOCS,
    min_df=TOPIC_MIN_DF,
    size=VOCABULARY_SIZE,
    stop_words=STOP_WORDS,
):
    """Fold the term statistics of batch `version`, then move the model by one step on its texts.

    A repeated batch starts from the version before it and gives the same model again. The
    model's prior on words and topics is 1 / k, as in the batch form. Languages with fewer than
    `min_docs` texts so far have no model.
    """
    spark = new.sparkSession
    with temporary(spark):
        docs = text_eligible(new, languages)
        terms.fold_terms(new, f"{path}/terms", version, languages, stop_words)
        totals = write_table(terms.statistics(spark, f"{path}/terms"), "topic-statistics")
        corpus = docs_of_statistics(totals, min_docs).withColumnRenamed("docs", "corpus")
        # One row per target language.
        vocab = vocabulary(totals, min_df, size).join(F.broadcast(corpus), "language", "left_semi")
        before = snapshots.read_latest(spark, f"{path}/model", below=version)
        model = write_table(online_topics.with_vocabulary(before, vocab, k), "topic-model")
        frequencies = docs.select("language", "id", counted_terms(stop_words).alias("terms"))
        summed = write_table(online_topics.statistics(frequencies, model, 1.0 / k), "topic-sums")
        moved = online_topics.step(model, summed, version, corpus, 1.0 / k)
        snapshots.write_version(moved, f"{path}/model", version)


def current_topics(spark, path, words=TOPIC_WORDS):
    """(language, topic_id, rank, word, weight) of the latest model, or None before the first."""
    model = snapshots.read_latest(spark, f"{path}/model")
    return None if model is None else online_topics.top_words(model, words)
