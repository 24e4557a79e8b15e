"""The physical plans keep the properties that matter at scale."""

import re

import pytest

from repotide.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [
    n
    for n in QUERIES
    if not n.startswith(("stream_", "snapshot_", "lda", "topic_", "sink_", "arrival"))
]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["top10_words", "vocab_topn", "entity_top5"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


@pytest.mark.parametrize(
    "name, schema",
    [
        ("total_count_by_language", "struct<event_id:bigint,user_id:bigint,event_type:string>"),
        ("avg_stars_by_language", "struct<lang:string,n_chars:bigint>"),
        ("monthly_growth", "struct<o_orderdate:timestamp_ntz,o_orderpriority:string>"),
        ("word_counts", "struct<text:string,lang:string>"),
    ],
)
def test_scans_read_only_what_they_need(spark, name, schema):
    read = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan(spark, name)))
    assert read == {schema}


def test_target_filter_reaches_the_scan(spark):
    assert re.search(r"PushedFilters: \[.*In\(lang", plan(spark, "vocab_topn"))


def test_statistics_serve_both_vocabulary_and_document_counts(spark):
    df = QUERIES["idf_weights"](spark, SF)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_shuffled_once(spark):
    text = plan(spark, "cosine_banded")
    after_blocks = text[: text.index("REPARTITION_BY_COL")]
    assert after_blocks.count("Exchange hashpartitioning") == 1
