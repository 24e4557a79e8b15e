"""Two tokenizers that must stay distinct: one for counting words, one for vectors."""

from pyspark.sql import functions as F

from repotide.contract import SNIPPET_CHARS, STOP_WORDS
from repotide.functions.expressions import bind

WHITESPACE = " \t\n\x0b\f\r"


def clean_words(text):
    """ASCII letters only, lower case. Others are deleted, so `Foo-Bar` is one word.

    Alpha is a-z and A-Z. Java matches it about ten times as fast as the two ranges.
    """
    letters = F.lower(F.regexp_replace(text, r"[^\p{Alpha} ]", ""))
    return F.array_remove(F.split(letters, " "), "")


def trimmed_text(text):
    return F.rtrim(F.lower(text), F.lit(WHITESPACE))


def ml_tokens(text):
    """Lower case, split at each whitespace; punctuation and inner empty tokens stay."""
    trimmed = trimmed_text(text)
    nothing = F.array().cast("array<string>")
    return F.when(F.length(trimmed) == 0, nothing).otherwise(F.split(trimmed, r"\s"))


def drop_stop_words(tokens, stop_words=STOP_WORDS):
    return F.filter(tokens, lambda token: ~token.isin(*stop_words))


def term_counts(tokens):
    """array<struct<term, tf>> of one document.

    Sorting inside the row and measuring the runs counts the terms without a shuffle of
    (document, term) rows.
    """

    def runs(ordered):
        is_first = lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), is_first)
        return bind(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - start)
                    .cast("long")
                    .alias("tf"),
                ),
            ),
        )

    # sequence(0, -1) would count down, so empty documents skip the runs.
    return bind(F.sort_array(tokens), lambda t: F.when(F.size(t) > 0, runs(t)))


def snippet(text, chars=SNIPPET_CHARS):
    return F.concat(F.substring(text, 1, chars), F.lit("..."))
