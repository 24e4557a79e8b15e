"""The corpus pipeline: documents through the stages in STAGES, each written and read again.

Each stage is a function of (spark, docs, sf_dir) over all that its predecessor kept. All but
the last return the columns of `documents`; n_chars follows the text. Null texts, empty tables
and extra columns are handled as the operators' docstrings say; extra columns are left out.
"""

import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

import public_tokenizers  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from repotide.llm import bpe, decontamination, line_dedup, ngram_join, quality_rules  # noqa: E402
from repotide.llm.common import table  # noqa: E402
from repotide.scratch import write_table  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: What the verdict on a row can depend on, besides other rows.
JUDGED = ("doc_id", "text", "lang", "source")


def _numbered(docs):
    """The documents, each with a 64-bit number of its own content in place of the doc_id, so that
    rows which share an id, or have none, are judged one by one. Equal rows share a number."""
    return docs.select(F.xxhash64(*JUDGED).alias("doc_id"), *COLUMNS[1:])


def _kept(docs, verdicts):
    """The rows of `docs` whose number is in `verdicts`."""
    numbers = verdicts.select(F.col("doc_id").alias("_number")).distinct()
    return docs.join(numbers, F.xxhash64(*JUDGED) == F.col("_number"), "left_semi").select(*COLUMNS)


def quality(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return _kept(docs, quality_rules.judged(_numbered(docs)).where("kept"))


def lines(spark, docs, sf_dir):
    """Repeated chunks and runs of lines go from the texts; a document of which nothing is left
    goes too."""
    rows = line_dedup.deduplicated(docs.select(*COLUMNS))
    # A filter on the new text would be pushed below the steps that make it, and make it again
    # for each use; it stays above a generator.
    rows = rows.select(F.inline(F.array(F.struct(*rows.columns))))
    rows = rows.where((F.col("n_removed_lines") == 0) | (F.trim("text") != ""))
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark, docs, sf_dir):
    """Of each class of similar documents the one with the smallest doc_id stays; a null one only
    if the class has no other."""
    classes = ngram_join.similar_classes(_numbered(docs)).select("doc_id", "class_id").distinct()
    named = docs.select(F.xxhash64(*JUDGED).alias("doc_id"), F.col("doc_id").alias("name")).distinct()
    order = F.struct(F.col("name").isNull().alias("none"), "name", "doc_id")
    first = classes.join(named, "doc_id").groupBy("class_id").agg(F.min(order)["doc_id"].alias("doc_id"))
    return _kept(docs, first)


def benchmark(spark, docs, sf_dir):
    """Contaminated documents go; others keep their whole text."""
    spans = decontamination.removal_spans(_numbered(docs), table(spark, sf_dir, "benchmark"))
    return _kept(docs, decontamination.judged(spans).where(~F.col("contaminated")))


def tokens(spark, docs, sf_dir):
    """Ids of each text, with hashes of the ids and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), ("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]
#: Outlier estimates, sketches and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
