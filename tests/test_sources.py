import json
import os

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from repotide import scratch
from repotide.operators import similarity, topics
from repotide.plans.report import all_sections, recent_section, snapshot_payload
from repotide.sources import ndjson, search, snapshots

GOOD = '{"id":1,"name":"a","language":"Python","description":"x ai","stargazers_count":5,"pushed_at":"2024-01-01T00:00:10Z"}'


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_wire_line(spark):
    parsed = ndjson.parse_lines(lines(spark, GOOD))
    row = ndjson.good_rows(parsed).first()
    assert (row.id, row.language, row.stargazers_count) == (1, "Python", 5)
    assert row.pushed_at == at("2024-01-01 00:00:10")


def test_bad_lines_are_set_aside(spark):
    bad = ["not json", "", "[1]", '{"name":"no id","pushed_at":"2024-01-01T00:00:10Z"}',
           '{"id":2,"pushed_at":"yesterday"}', '{"id":"x","pushed_at":"2024-01-01T00:00:10Z"}', GOOD[:-5]]
    parsed = ndjson.parse_lines(lines(spark, GOOD, *bad))
    assert rows(ndjson.good_rows(parsed), "id") == [(1,)]
    assert rows(ndjson.quarantined_lines(parsed)) == sorted((b,) for b in bad)


def test_null_description_is_good(spark):
    line = GOOD.replace('"x ai"', "null")
    assert rows(ndjson.good_rows(ndjson.parse_lines(lines(spark, line))), "id", "description") == [(1, None)]


def test_written_lines_parse_back(repos, spark, tmp_path):
    df = repos({"pushed_at": at("2024-01-01 00:00:10"), "description": 'a "b"\nc', "stargazers_count": 3})
    ndjson.write_lines(df, str(tmp_path / "out"))
    back = ndjson.good_rows(ndjson.parse_lines(spark.read.text(str(tmp_path / "out"))))
    assert rows(back) == rows(df)


def test_search_response(spark):
    item = {"id": 1, "name": "a", "language": "Python", "description": None, "stargazers_count": 2,
            "pushed_at": "2024-01-01T00:00:10Z", "forks": 9}
    payload = json.dumps({"total_count": 3, "items": [item, {**item, "id": 2, "language": None}, {**item, "id": 3, "language": "Go"}]})
    items = search.search_items(spark.createDataFrame([(payload,), ('{"items":[]}',)], "payload string"))
    kept = search.project_repo_fields(search.source_language_filter(items))
    assert kept.columns == list(search.WIRE_FIELDS)
    assert rows(kept, "id") == [(1,)]
    assert items.count() == 3


def test_only_the_latest_snapshot_is_kept(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    assert rows(snapshots.latest_snapshot(spark, path)) == [("no data", None)]
    assert snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path)).collect() == []
    for version in (0, 1, 2, 2):
        payload = spark.range(1).select(F.lit(json.dumps({"req1": [version]})).alias("payload"))
        snapshots.publish_snapshot(payload, path, version)
    assert rows(snapshots.latest_snapshot(spark, path)) == [("success", '{"req1": [2]}')]
    assert snapshots.published(spark, path) == [0, 1, 2]
    sections = dict(snapshots.snapshot_sections(snapshots.latest_snapshot(spark, path)).collect())
    assert sections["req1"] == "[2]"
    assert all(sections[f"req{n}"] == "[]" for n in (5, 6, 7, 8))


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    for version in (0, 2, 4, 6, 8):
        snapshots.publish_snapshot(spark.range(1).select(F.lit(f"{version}").alias("payload")), path, version)
    assert len(os.listdir(f"{path}/data")) == snapshots.KEPT
    # A writer dies after its data and before its pointer.
    spark.range(1).select(F.lit("half").alias("payload")).write.parquet(f"{path}/data/9")
    assert rows(snapshots.latest_snapshot(spark, path), "payload") == [("8",)]
    assert snapshots.next_version(spark, path) == 9
    snapshots.publish_snapshot(spark.range(1).select(F.lit("9").alias("payload")), path, 9)
    assert rows(snapshots.latest_snapshot(spark, path), "payload") == [("9",)]


def test_recent_pushes_are_listed_in_time_order(spark):
    times = ["2024-01-01 23:59:00", "2024-01-02 00:01:00", "2024-01-02 00:00:00"]
    history = spark.createDataFrame([(at(t), "b" if k else "a", k) for k, t in enumerate(times)], "batch_time timestamp, language string, count long")
    payload = json.loads(snapshot_payload({"req2": recent_section(history)}).first().payload)
    assert [(r["count"], r["batch_label"]) for r in payload["req2"]] == [(0, "23:59:00"), (2, "00:00:00"), (1, "00:01:00")]


@pytest.mark.parametrize("compact", [2, 100])
def test_totals_add_up_each_batch_once(spark, tmp_path, monkeypatch, compact):
    monkeypatch.setattr(snapshots, "COMPACT_EVERY", compact)
    path, shape = str(tmp_path / "totals"), (["k"], ["n"], ["first"])
    assert snapshots.read_totals(spark, path, *shape) is None
    delta = spark.createDataFrame([("a", 2, 5), ("b", 1, 3)], "k string, n long, first long")
    for version in (0, 1, 1, 2, 3, 3, 4):
        snapshots.add_to_totals(delta, path, version, *shape)
    assert rows(snapshots.read_totals(spark, path, *shape), "k", "n", "first") == [("a", 10, 5), ("b", 5, 3)]


def test_payload_is_one_object(spark):
    section = spark.createDataFrame([("b", 1), ("a", 2)], "language string, count long")
    payload = snapshot_payload({"req1": section, "req2": section.where("false")}).collect()
    assert len(payload) == 1
    assert json.loads(payload[0].payload) == {
        "req1": [{"language": "a", "count": 2}, {"language": "b", "count": 1}],
        "req2": [],
    }


def test_scratch_is_below_the_shared_folder(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/{spark.sparkContext.applicationId}"
    assert scratch.scratch_path(spark, "x").startswith(f"{folder}/x-")
    table = scratch.write_table(spark.range(3), "y")
    assert rows(table) == [(0,), (1,), (2,)]


def test_topics_and_pairs_share_one_count_of_terms(repos, monkeypatch):
    def counted_again(*_):
        raise AssertionError("the terms are counted again")

    monkeypatch.setattr(topics, "term_statistics", counted_again)
    monkeypatch.setattr(similarity, "term_statistics", counted_again)
    df = repos({"description": "a1 b1"}, {"description": "a1 b1"}, {"description": "c1"})
    history = df.selectExpr("pushed_at AS batch_time", "language", "1L AS count").where("false")
    sections = all_sections(df, history, at("2024-07-01 00:00:00"), ("Python",))
    assert [r.total_repos_analyzed for r in sections["req7"].collect()] == [3]
    assert sections["req5"].collect() == []
