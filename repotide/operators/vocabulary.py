"""Terms, vocabulary and TF-IDF weights, for all languages in one plan.

Functions taking `docs` expect rows from `text_eligible`.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.contract import LANGUAGES, STOP_WORDS, VOCABULARY_SIZE
from repotide.functions.expressions import target_language
from repotide.functions.text import drop_stop_words, ml_tokens, term_counts, trimmed_text
from repotide.operators.arrow_terms import counted, split_texts
from repotide.operators.ranking import top_k
from repotide.scratch import write_table

# Bytes of terms that a side may have to be broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 << 20
# Copies of the terms in that join, so that a frequent term is not one task's work.
SALTS = 16


def text_eligible(repos, languages=LANGUAGES):
    return repos.where((F.col("description") != "") & target_language(languages))


def doc_counts(docs):
    return docs.groupBy("language").agg(F.count("*").alias("docs"))


def min_docs_gate(docs, min_docs):
    """Rows of the languages that have enough documents."""
    # One row per target language, so the broadcast side is bounded by the parameter.
    enough = doc_counts(docs).where(F.col("docs") >= min_docs)
    return docs.join(F.broadcast(enough), "language", "left_semi")


def tokens(docs):
    return docs.withColumn("tokens", ml_tokens(F.col("description")))


def filtered_tokens(docs, stop_words=STOP_WORDS):
    return docs.withColumn(
        "tokens", drop_stop_words(ml_tokens(F.col("description")), stop_words)
    )


def counted_terms(stop_words=STOP_WORDS):
    return term_counts(drop_stop_words(ml_tokens(F.col("description")), stop_words))


def term_frequencies(docs, stop_words=STOP_WORDS):
    """(language, id, term, tf) over all terms; the counts are made inside each row."""
    return docs.select("language", "id", F.inline(counted_terms(stop_words)))


def term_statistics(docs, stop_words=STOP_WORDS):
    """(language, term, corpus_count, doc_count), plus one row per language with a null term
    and a corpus_count of 0 that holds the number of documents.

    Counting the documents along with the terms saves a second pass over the texts. A task counts the
    terms of an Arrow batch as numbers, so a term is one row for each batch, not for each document.
    """
    stopped = list(stop_words)

    def count(batches):
        for batch in batches:
            yield _batch_statistics(batch, stopped)

    rows = docs.select("language", trimmed_text(F.col("description")).alias("text"))
    parts = rows.mapInArrow(
        count,
        T.StructType(
            [
                rows.schema["language"],
                T.StructField("term", T.StringType()),
                T.StructField("corpus_count", T.LongType()),
                T.StructField("doc_count", T.LongType()),
            ]
        ),
    )
    return parts.groupBy("language", "term").agg(
        F.sum("corpus_count").alias("corpus_count"), F.sum("doc_count").alias("doc_count")
    )


def _counted_without(tokens, stopped):
    """`counted` without the stop words."""
    rows, codes, counts, terms = counted(tokens)
    kept = ~pc.is_in(terms, value_set=pa.array(stopped, terms.type)).to_numpy(zero_copy_only=False)[codes]
    return rows[kept], codes[kept], counts[kept], terms


def _batch_statistics(batch, stopped):
    rows, codes, counts, terms = _counted_without(split_texts(batch.column("text")), stopped)
    languages = batch.column("language").dictionary_encode(null_encoding="encode")
    own, width = languages.indices.to_numpy(), max(len(terms), 1)
    keys, places = np.unique(own[rows].astype(np.int64) * width + codes, return_inverse=True)
    corpus = np.bincount(places, counts, len(keys)).astype(np.int64)
    docs = np.bincount(own, minlength=len(languages.dictionary))
    markers = np.arange(len(docs))
    return pa.RecordBatch.from_arrays(
        [
            languages.dictionary.take(pa.array(np.concatenate([keys // width, markers]))),
            pa.concat_arrays([terms.take(pa.array(keys % width)), pa.nulls(len(docs), terms.type)]),
            pa.array(np.concatenate([corpus, np.zeros(len(docs), np.int64)])),
            pa.array(np.concatenate([np.bincount(places, minlength=len(keys)), docs])),
        ],
        ["language", "term", "corpus_count", "doc_count"],
    )


def document_weights(docs, by_language, stop_words=STOP_WORDS, unit=False):
    """(language, id, indices, values): TF-IDF weights of each text as a sparse vector over the terms
    of its language, by number; of length 1 if `unit` and there is any weight.

    `by_language` has the (term, idf) pairs of each language in the order of their numbers, at most
    `size` each. A narrow step: texts are counted in Arrow batches where they are read.
    """
    stopped = list(stop_words)

    def weigh(batches):
        for batch in batches:
            yield _batch_weights(batch, by_language, stopped, unit)

    rows = docs.select("language", "id", trimmed_text(F.col("description")).alias("text"))
    entries = [T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(weigh, T.StructType([rows.schema["language"], rows.schema["id"], *entries]))


def _batch_weights(batch, by_language, stopped, unit):
    rows, codes, counts, terms = _counted_without(split_texts(batch.column("text")), stopped)
    languages = batch.column("language").dictionary_encode(null_encoding="encode")
    own = languages.indices.to_numpy()[rows]
    places, weights = np.full(len(rows), -1), np.zeros(len(rows))
    for number, language in enumerate(languages.dictionary.to_pylist()):
        known = by_language.get(language)
        if known:
            among = pc.index_in(terms, value_set=pa.array([t for t, _ in known], terms.type)).fill_null(-1).to_numpy()
            at = np.flatnonzero(own == number)
            places[at] = among[codes[at]]
            weights[at] = counts[at] * np.array([idf for _, idf in known])[places[at]]
    order = np.lexsort((places, rows))
    order = order[places[order] >= 0]
    rows, places, weights = rows[order], places[order], weights[order]
    if unit:
        lengths = np.sqrt(np.bincount(rows, weights * weights, batch.num_rows))[rows]
        weights = np.divide(weights, lengths, out=weights.copy(), where=lengths != 0)
    ends = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
    listed = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (places.astype(np.int32), weights)]
    return pa.RecordBatch.from_arrays([batch.column("language"), batch.column("id"), *listed], ["language", "id", "indices", "values"])


def docs_of_statistics(statistics, min_docs=0):
    """(language, docs) of the languages with at least `min_docs` documents."""
    docs = F.max(F.when(F.col("corpus_count") == 0, F.col("doc_count")))
    return statistics.groupBy("language").agg(docs.alias("docs")).where(F.col("docs") >= min_docs)


def vocabulary(statistics, min_df, size=VOCABULARY_SIZE):
    """Per language the `size` most frequent terms found in at least `min_df` documents."""
    known = (F.col("corpus_count") > 0) & (F.col("doc_count") >= min_df)
    order = [F.desc("corpus_count"), F.asc("term")]
    return top_k(statistics.where(known), ["language"], order, size)


def idf_weights(vocab, docs_per_language):
    idf = F.log((F.col("docs") + 1) / (F.col("doc_count") + 1))
    # At most one row per target language.
    return vocab.join(F.broadcast(docs_per_language), "language").withColumn("idf", idf)


def join_terms(rows, terms):
    """Inner join of `rows` with `terms` on (language, term), whatever the size of `terms`.

    The terms are written once and their bytes summed. Beyond BROADCAST_BYTES both sides are
    shuffled by term and salt.
    """
    terms = write_table(terms, "terms")
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(terms), ["language", "term"])
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    copies = terms.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(copies, ["language", "term", "_salt"]).drop("_salt")


def vocabulary_frequencies(docs, vocab, stop_words=STOP_WORDS):
    """Counts of vocabulary terms per document."""
    return join_terms(term_frequencies(docs, stop_words), vocab.select("language", "term"))


def tfidf_weights(docs, idf, stop_words=STOP_WORDS):
    weighted = join_terms(term_frequencies(docs, stop_words), idf.select("language", "term", "idf"))
    return weighted.withColumn("weight", F.col("tf") * F.col("idf")).drop("idf")
