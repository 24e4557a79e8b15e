"""Term statistics of all texts so far, from those of each micro-batch.

Counts of terms and of documents add up, so a micro-batch reads its own texts only. Its
(language, term) counts are a delta; deltas become part of a base now and then. The sum of base
and deltas is `vocabulary.term_statistics` over all texts, whatever the batches were, and gives
vocabulary, document counts and IDF weights without reading a text again.
"""

from repotide.contract import LANGUAGES, STOP_WORDS
from repotide.operators.vocabulary import term_statistics, text_eligible
from repotide.sources import snapshots
from repotide.streaming.run import start

TERM_TOTALS = (["language", "term"], ["corpus_count", "doc_count"])
STATISTICS = "language string, term string, corpus_count long, doc_count long"


def fold_terms(new, path, version, languages=LANGUAGES, stop_words=STOP_WORDS):
    """Add the texts of batch `version`; repeating a batch changes nothing."""
    counted = term_statistics(text_eligible(new, languages), stop_words)
    snapshots.add_to_totals(counted, path, version, *TERM_TOTALS)


def maintain_terms(stream, path, checkpoint, languages=LANGUAGES, stop_words=STOP_WORDS, interval=None):
    """Fold each micro-batch of new repositories."""

    def fold(rows, batch_id):
        fold_terms(rows, path, batch_id, languages, stop_words)

    return start(stream.writeStream.foreachBatch(fold), checkpoint, interval)


def statistics(spark, path):
    """The statistics so far, in the form of `vocabulary.term_statistics`."""
    totals = snapshots.read_totals(spark, path, *TERM_TOTALS)
    return spark.createDataFrame([], STATISTICS) if totals is None else totals
