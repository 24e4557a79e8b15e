"""One query per operator: applied to its whole table with production parameters."""

import public_tokenizers

from repotide.llm import bpe, decontamination, filter_audit, language_id, licenses, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, warc, whitening
from repotide.llm.common import table

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op4_decontamination(spark, sf_dir):
    spans = decontamination.removal_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.judged(spans)


@query
def op7_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op2_license_scan(spark, sf_dir):
    return licenses.license_labels(table(spark, sf_dir, "documents"))


@query
def op3_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op5_warc(spark, sf_dir):
    return warc.records(warc.round_trip(table(spark, sf_dir, "pages")))


ORACLES["op5_warc"] = warc.ORACLE


@query
def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs)


ORACLES["op6_line_dedup"] = line_dedup.ORACLE


@query
def op8_ngram_join(spark, sf_dir):
    return ngram_join.similar_classes(table(spark, sf_dir, "documents"))


@query
def op1_language_id(spark, sf_dir):
    return language_id.predicted(table(spark, sf_dir, "documents"))


@query
def op9_quality_classifier(spark, sf_dir):
    return quality_classifier.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_personal_data(spark, sf_dir):
    return pii.detected(table(spark, sf_dir, "documents"))


@query
def op11_packing(spark, sf_dir):
    return packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = filter_audit.ORACLE
