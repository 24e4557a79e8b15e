"""Forms that grow with their input equal one pass over everything."""

import json
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streams import record, stream_of, write_lines, write_parts

from repotide.operators import counts, entities, entity_index, similarity, state, trends, vocabulary
from repotide.plans import tables
from repotide.plans.registry import DAY, EVENT_SCHEMA, HALF_DAY
from repotide.scratch import read_existing
from repotide.sources import ndjson, snapshots, tiers
from repotide.streaming import bands, expiry, landing, lifetime, observed, refresh, terms, windows
from repotide.streaming.run import finish, start

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return tables.events(spark, SF).select(*EVENT_SCHEMA.names)


@pytest.fixture(scope="module")
def documents(spark):
    return tables.documents(spark, SF)


def parts_of(df, n):
    top = df.agg(F.max("seq")).first()[0] + 1
    return [df.where((F.col("seq") >= top * k // n) & (F.col("seq") < top * (k + 1) // n)) for k in range(n)]


# Entities


def dictionary(spark, names):
    return spark.createDataFrame([("t", name, n) for n, name in enumerate(names)], "entity_type string, name string, entry int")


def mentioned(df):
    return rows(df, "id", "name", "entry")


ODD_NAMES = ["ai", "a", "", None, "docker", "dock", "é", "😀x", "a😀bc", "web api", "zzzz", "docker", ". d", "ab\nc", "aaaa", "x" * 40]
ODD_TEXTS = ["Docker on AWS again", "AI", "", None, "é😀x a😀bc", "web  api web api", "AB\nC", "aaa", "aaaaa", "no. docker", "x" * 39, "x" * 41]


@pytest.mark.parametrize("limit", [entity_index.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("q", [1, 4])
def test_index_finds_what_contains_finds(spark, repos, limit, q):
    docs = repos(*[{"description": t} for t in ODD_TEXTS])
    found = entity_index.entity_mentions(docs, dictionary(spark, ODD_NAMES), q, limit)
    expected = sorted(
        (n, name, entry)
        for n, text in enumerate(ODD_TEXTS)
        for entry, name in enumerate(ODD_NAMES)
        if text is not None and name is not None and name in text.lower()
    )
    assert mentioned(found) == expected


def test_index_gives_the_rows_of_the_literal_dictionary(spark, documents):
    docs = vocabulary.text_eligible(documents, tables.TEXT_LANGUAGES)
    table = entities.entity_dictionary(spark)
    assert rows(entity_index.entity_mentions(docs, table)) == rows(entities.entity_mentions(docs).select(*entity_index.MENTION))


def test_words_are_looked_up_where_texts_are_read(spark, repos):
    """Per text one row of numbers, not one of each q-gram; a pattern may span words or hold none."""
    names = ["big data", "g d", " data", "data\t", "dat", "", " ", "a\xa0b", "data a", "big  data"]
    texts = ["Big Data", "big  data", "xbig\tdatax", "DATA\tA\xa0B", "", "big dat", "data a data a"]
    docs = repos(*[{"description": t} for t in texts], {"description": "big data", "id": 0, "seq": 99})
    found = entity_index.entity_mentions(docs, dictionary(spark, names))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "explode(numbers" in plan
    expected = [(n, m, e) for n, t in enumerate(texts) for e, m in enumerate(names) if m in t.lower()]
    expected += [(0, m, e) for e, m in enumerate(names) if m in "big data"]
    assert mentioned(found) == sorted(expected)


def test_an_index_serves_other_texts(spark, repos):
    names = ["docker", "redis", "ai"]
    first, second = repos({"description": "docker ai"}), repos({"description": "Redis and AI"})
    index = entity_index.gram_index(first, dictionary(spark, names), other_texts=True)
    assert mentioned(entity_index.entity_mentions(second, index=index)) == [(0, "ai", 2), (0, "redis", 1)]
    assert mentioned(entity_index.entity_mentions(first, index=index)) == [(0, "ai", 2), (0, "docker", 0)]


def test_a_hundred_thousand_patterns(spark, repos):
    """The dictionary is a table: the plan holds no literal of it."""
    many = spark.range(100_000).select(F.lit("t").alias("entity_type"), F.concat(F.lit("name"), "id").alias("name"), F.lit(0).alias("entry"))
    docs = repos({"description": "Name77 and name4242 and nam"}, {"description": None}, {"description": "name99999name100000"})
    found = entity_index.entity_mentions(docs, many)
    assert rows(found, "id", "name") == sorted(
        [(0, f"name{n}") for n in ("4", "42", "424", "4242", "7", "77")]
        + [(2, f"name{n}") for n in ("9", "99", "999", "9999", "99999", "1", "10", "100", "1000", "10000")]
    )
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_empty_dictionary_and_no_texts(spark, repos):
    docs = repos({"description": "docker"})
    assert entity_index.entity_mentions(docs, dictionary(spark, [])).collect() == []
    assert entity_index.entity_mentions(docs, dictionary(spark, [None])).collect() == []
    assert entity_index.entity_mentions(docs.limit(0), dictionary(spark, ["docker"])).collect() == []


# Closed windows


@pytest.mark.parametrize("parts", [1, 10])
def test_closed_windows_equal_the_batch_form(spark, events, tmp_path, parts):
    source, path = write_parts(events, str(tmp_path), parts), str(tmp_path / "closed")
    job = finish(windows.maintain_closed_counts(stream_of(spark, events, source), path, str(tmp_path / "c"), "2 hours", DAY, HALF_DAY))
    batch = state.dedup_within_batch(state.assign_batch(events, DAY))
    newest = events.agg(F.max("pushed_at") - F.expr("INTERVAL 2 HOURS")).first()[0]
    expected = counts.recent_push_counts(batch, HALF_DAY).where(F.col("batch_time") <= F.lit(newest))
    columns = ("batch_time", "language", "count")
    assert rows(windows.closed_counts(spark, path), *columns) == rows(expected, *columns)
    if parts > 1:
        held, seen = windows.state_rows(job), 0
        assert max(held) < batch.count() and held[-1] < max(held)


def test_rows_behind_the_watermark_change_nothing(spark, events, tmp_path):
    source, path = write_parts(events, str(tmp_path), 3), str(tmp_path / "closed")
    run = lambda: finish(windows.maintain_closed_counts(stream_of(spark, events, source), path, str(tmp_path / "c"), "2 hours", DAY, HALF_DAY))
    run()
    before = rows(windows.closed_counts(spark, path))
    early = events.orderBy("pushed_at").limit(20).withColumns({"id": F.col("id") + 10**6, "seq": F.col("seq") - 10**6})
    early.coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(windows.closed_counts(spark, path)) == before


def test_no_window_has_closed(spark, events, tmp_path):
    assert rows(windows.closed_counts(spark, str(tmp_path / "none"))) == []


# First versions with a bound


def sessions(versions, seconds):
    """[(id, seq)] by a loop over the versions (id, time, seq)."""
    out, last = [], {}
    for id, at, seq in sorted(versions):
        if id not in last or (at - last[id]).total_seconds() > seconds:
            out.append((id, seq))
        last[id] = at
    return sorted(out)


def test_sessions_equal_a_loop(events):
    versions = [(r.id, r.pushed_at, r.seq) for r in events.collect()]
    found = expiry.first_of_sessions(events, "6 hours")
    assert rows(found, "id", "seq") == sessions(versions, 6 * 3600)
    assert rows(found.join(events, ["id", "seq", "language", "stargazers_count", "pushed_at"], "left_anti")) == []


def test_gaps_at_the_bound(spark, repos):
    from conftest import at

    times = ["2024-01-01 00:00:00", "2024-01-01 00:59:59", "2024-01-01 01:59:59", "2024-01-01 03:00:00", "2024-01-01 03:00:00"]
    df = repos(*[{"id": 1, "seq": 9 - n, "pushed_at": at(t)} for n, t in enumerate(times)])
    assert rows(expiry.first_of_sessions(df, "1 hour"), "id", "seq") == [(1, 5), (1, 9)]


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_of_sessions_equals_the_batch_form(spark, events, tmp_path, parts):
    """Over a restart in the middle, up to the sessions that are still open."""
    source, out = write_parts(events, str(tmp_path), parts), str(tmp_path / "out")
    later = sorted(os.listdir(source))[parts // 2 :] if parts > 1 else []
    os.makedirs(tmp_path / "later")
    for name in later:
        shutil.move(f"{source}/{name}", tmp_path / "later" / name)

    def run():
        kept = expiry.first_seen_within(stream_of(spark, events, source), "6 hours", "2 hours")
        writer = kept.writeStream.outputMode("append").format("parquet").option("path", out)
        return finish(start(writer, str(tmp_path / "c")))

    run()
    for name in later:
        shutil.move(tmp_path / "later" / name, f"{source}/{name}")
    job = run()
    found = rows(spark.read.parquet(out), "id", "seq", "language")
    expected = rows(expiry.first_of_sessions(events, "6 hours"), "id", "seq", "language")
    assert len(found) == len(set(found)) and set(found) <= set(expected)
    newest = events.agg(F.max("pushed_at") - F.expr("INTERVAL 8 HOURS")).first()[0]
    old = {r.id for r in events.where(F.col("pushed_at") > F.lit(newest)).select("id").distinct().collect()}
    assert {r for r in expected if r[0] not in old} <= set(found)
    assert windows.state_rows(job)[-1] < events.count()


def test_ids_once_within_a_bound(spark, events, tmp_path):
    source, out = write_parts(events, str(tmp_path), 4), str(tmp_path / "out")
    run = lambda: finish(start(expiry.ids_within(stream_of(spark, events, source), "40 days").writeStream.format("parquet").option("path", out), str(tmp_path / "c")))
    run()
    expected = rows(events.select("id").distinct())
    assert rows(spark.read.parquet(out)) == expected
    events.limit(50).withColumn("seq", F.col("seq") + 10**6).coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(spark.read.parquet(out)) == expected


# Counts from the state


def test_state_equals_the_batch_form_after_a_restart(spark, events, tmp_path):
    source, checkpoint = write_parts(events, str(tmp_path), 4), str(tmp_path / "c")
    last = sorted(os.listdir(source))[-1]
    shutil.move(f"{source}/{last}", tmp_path / last)
    run = lambda: finish(lifetime.maintain_state(stream_of(spark, events, source), checkpoint))
    run()
    assert lifetime.lifetime_state(spark, checkpoint).count() <= events.select("id").distinct().count()
    shutil.move(tmp_path / last, f"{source}/{last}")
    run()
    unique = state.dedup_first_seen(events)
    totals = lifetime.state_totals(spark, checkpoint)
    assert rows(counts.counts_of_totals(totals)) == rows(counts.total_count_by_language(unique))
    assert rows(counts.averages_of_totals(totals)) == rows(counts.avg_stars_by_language(unique))
    columns = ("id", "seq", "language", "stargazers_count")
    assert rows(lifetime.lifetime_state(spark, checkpoint), *columns) == rows(unique, *columns)
    assert not os.path.exists(tmp_path / "totals")


# Term statistics, months and neighbours


@pytest.mark.parametrize("parts", [1, 3, 18])
def test_folded_terms_equal_a_full_pass(spark, documents, tmp_path, parts):
    path = str(tmp_path / "terms")
    docs = documents.where("seq < 60")
    for n, part in enumerate(parts_of(docs, parts)):
        for _ in range(2 if n in (0, 2) else 1):  # a repeated batch changes nothing
            terms.fold_terms(part, path, n, tables.TEXT_LANGUAGES)
    expected = vocabulary.term_statistics(vocabulary.text_eligible(docs, tables.TEXT_LANGUAGES))
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    columns = ("language", "term", "corpus_count", "doc_count")
    found = terms.statistics(spark, path).select(*columns).collect()
    assert sorted(map(key, found)) == sorted(map(key, expected.select(*columns).collect()))


def test_terms_of_a_stream(spark, documents, tmp_path):
    source = write_parts(documents, str(tmp_path), 2)
    stream = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", 1).parquet(source)
    finish(terms.maintain_terms(stream, str(tmp_path / "t"), str(tmp_path / "c"), tables.TEXT_LANGUAGES))
    expected = vocabulary.term_statistics(vocabulary.text_eligible(documents, tables.TEXT_LANGUAGES))
    found = terms.statistics(spark, str(tmp_path / "t"))
    assert rows(vocabulary.vocabulary(found, 2)) == rows(vocabulary.vocabulary(expected, 2))
    assert rows(terms.statistics(spark, str(tmp_path / "none"))) == []


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_folded_neighbours_equal_a_full_pass(spark, documents, tmp_path, parts):
    path = str(tmp_path / "band")
    for n, part in enumerate(parts_of(documents, parts)):
        for _ in range(2 if n == 1 else 1):
            bands.fold_pairs(part, path, n, tables.TEXT_LANGUAGES)
    docs = vocabulary.text_eligible(documents, tables.TEXT_LANGUAGES)
    columns = ("language", "id1", "id2")
    assert rows(bands.pairs(spark, path), *columns) == rows(similarity.band_candidates(docs), *columns)
    tail = snapshots.read_latest(spark, f"{path}/tail")
    assert max(r["count"] for r in tail.groupBy("language").count().collect()) == 5


def test_neighbours_of_a_batch_smaller_than_the_band(spark, repos, tmp_path):
    df = repos(*[{"description": "x"} for _ in range(7)], {"description": ""}, {"description": "y", "language": "Go"})
    path = str(tmp_path / "band")
    for n in range(9):
        bands.fold_pairs(df.where(F.col("seq") == n), path, n)
    assert rows(bands.pairs(spark, path), "id1", "id2") == [(a, b) for a in range(7) for b in range(a + 1, min(a + 6, 7))]


def test_folded_months_equal_a_full_pass(spark, repos, tmp_path):
    from conftest import at

    df = repos(*[
        {"language": "Java" if n % 3 else "Python", "stargazers_count": None if n % 5 == 0 else n, "created_at": at(f"2024-0{1 + n % 4}-03 00:00:00")}
        for n in range(24)
    ])
    for n, part in enumerate(parts_of(df, 4)):
        for _ in range(2):
            refresh.fold_counts(part, str(tmp_path), n)
    expected = trends.monthly_rollup(trends.dated_rows(df))
    assert rows(refresh.month_totals(spark, str(tmp_path))) == rows(expected)
    assert rows(refresh.month_totals(spark, str(tmp_path / "none"))) == []


# Tiers


def test_tiers_keep_rows_and_few_folders(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "batch long, x long"
    for n in range(17):
        tiers.append(spark.range(3).select(F.lit(n).cast("long").alias("batch"), F.col("id").alias("x")), path, n)
        if n % 8 == 0:
            tiers.append(spark.range(9).select(F.lit(n).cast("long").alias("batch"), F.col("id").alias("x")), path, n)
        if n in (3, 7, 8, 15, 16):
            assert rows(tiers.read(spark, path, schema)) == sorted((b, x) for b in range(n + 1) for x in range(3))
    listed = tiers.folders(spark, path)
    assert [(x[1], x[2], x[3]) for x in listed] == [(1, 0, 7), (1, 8, 15), (0, 16, 16)]
    on_disk = {f"tiers/{n}" for n in os.listdir(f"{path}/tiers")}
    assert {x[0] for x in listed} <= on_disk and len(on_disk) <= len(listed) + tiers.FAN + snapshots.KEPT
    assert {r.batch for r in tiers.between(spark, path, schema, 9, 9).collect()} == set(range(8, 16))
    assert rows(tiers.read(spark, str(tmp_path / "none"), schema)) == []


def test_a_reader_meets_no_gap_while_folders_merge(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "x long"
    for n in range(7):
        tiers.append(spark.range(n, n + 1).select(F.col("id").alias("x")), path, n)
    before = tiers.read(spark, path, schema)
    tiers.append(spark.range(7, 8).select(F.col("id").alias("x")), path, 7)
    assert rows(before) == [(n,) for n in range(7)]
    assert rows(tiers.read(spark, path, schema)) == [(n,) for n in range(8)]
    os.makedirs(f"{path}/tiers/0-99-99")  # of a writer that died
    tiers.append(spark.range(8, 9).select(F.col("id").alias("x")), path, 8)
    assert not os.path.exists(f"{path}/tiers/0-99-99")
    assert rows(tiers.read(spark, path, schema)) == [(n,) for n in range(9)]


# Observed metrics


def test_observed_metrics_equal_the_table_form(spark, tmp_path):
    inbox, path, table, batches = tmp_path / "inbox", str(tmp_path / "metrics"), str(tmp_path / "landed"), 104
    for n in range(batches):
        write_lines(inbox, f"{n:03d}.json", *[record(k, 10 * n + k) for k in range(n % 4)], *["bad"] * (1 + n % 2))
        os.utime(inbox / f"{n:03d}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    writer = observed.MetricsWriter(spark, path)
    spark.streams.addListener(writer)
    try:
        lines = ndjson.stream_lines(spark, path=str(inbox), maxFilesPerTrigger=1)
        parsed = observed.observed(ndjson.parse_lines(lines))

        def write(rows, batch_id):
            rows.select("line", "bad").write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

        finish(start(parsed.writeStream.foreachBatch(write), str(tmp_path / "c")))
        assert writer.wait(batches - 1)
    finally:
        spark.streams.removeListener(writer)
    landed = spark.read.parquet(table)
    expected = rows(landed.groupBy("batch").agg(F.count("*"), F.count_if("bad")).withColumn("batch", F.col("batch").cast("long")))
    found = observed.metrics(spark, path)
    assert rows(found, "batch", "input_rows", "bad_rows") == expected and len(expected) == batches
    assert observed.missing(found, landed).collect() == []
    assert min(r.uptime_seconds for r in found.collect()) == 0
    shutil.rmtree(f"{path}/batch=50")
    assert rows(observed.missing(observed.metrics(spark, path), landed)) == [(50,)]


def test_no_reports(spark, tmp_path):
    assert observed.metrics(spark, str(tmp_path / "none")).collect() == []
    assert read_existing(spark, str(tmp_path / "none")) is None


def test_refresh_from_folded_statistics_equals_a_full_pass(spark, tmp_path):
    """The published topics, pairs and trends are those of all repositories at once."""
    from repotide.app import run
    from repotide.plans import report

    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    texts = "api data cloud server web docker".split()
    made = lambda n: record(n, n, description=f"{texts[n % 6]} {texts[n % 4]} {texts[n % 5]} x", created_at=f"2024-0{1 + n % 4}-01T00:00:00Z")
    for n in range(2):
        write_lines(inbox, f"{n}.json", *[made(k) for k in range(8 * n, 8 * n + 8)])
        run(spark, ndjson.stream_lines(spark, path=str(inbox)), out, interval=None)
    payload = json.loads(snapshots.latest_snapshot(spark, f"{out}/snapshot").first().payload)
    repos = spark.read.parquet(f"{out}/repos").drop("batch_id")
    sections = {"req5": report.topic_section(repos), "req7": similarity.similar_pairs(repos), "req8": report.trend_section(repos, None)}
    expected = json.loads(report.snapshot_payload(sections).first().payload)
    assert payload["req7"] == expected["req7"] and payload["req8"] == expected["req8"]
    words = lambda p: [(t["topic_id"], t["top_words"]) for r in p["req5"] for t in r["topics"]]
    assert words(payload) == words(expected) and words(payload)
    assert landing.batch_metrics(landing.landed(spark, f"{out}/landed")).count() == 2


# Paged responses


def test_pages_go_on_after_a_restart_and_wait_for_missing_ones(spark, tmp_path):
    from repotide.sources import pages

    inbox, out = str(tmp_path / "pages"), str(tmp_path / "out")

    def land(*numbers):
        pages.land_pages(spark.createDataFrame([(n, f"p{n}") for n in numbers], "page long, payload string"), inbox)

    def run():
        stream = pages.stream_pages(spark, inbox, 2)
        job = finish(start(stream.writeStream.format("parquet").option("path", out), str(tmp_path / "c")))
        return job, rows(spark.read.schema(pages.SCHEMA).parquet(out))

    expected = lambda n: [(k, f"p{k}") for k in range(n)]
    land(0, 1, 2, 4, 5)
    assert run()[1] == expected(3)
    assert run()[1] == expected(3)
    land(3)
    assert run()[1] == expected(6)
    land(6, 7, 8, 9, 10)
    job, found = run()
    assert found == expected(11) and "11" in str(job.recentProgress[-1]["sources"][0]["endOffset"])


def test_no_pages_yet(spark, tmp_path):
    from repotide.sources import pages

    reader = pages.PageReader(str(tmp_path / "none"), 4)
    assert reader.latestOffset() == reader.initialOffset()
    assert [(p.first, p.stop) for p in reader.partitions({"page": 3}, {"page": 9})] == [(3, 7), (7, 9)]


# Topics with a warm start


def numpy_step(docs, weights, batch, corpus, k):
    """One step of online variational Bayes over dicts of term counts, written out."""
    import math

    def psi(x):
        step = 1e-5
        return (math.lgamma(x + step) - math.lgamma(x - step)) / (2 * step)

    names = list(weights)
    lam = [[float(x) for x in weights[t]] for t in names]
    columns = [sum(row[j] for row in lam) for j in range(k)]
    beta = [[math.exp(psi(row[j]) - psi(columns[j])) for j in range(k)] for row in lam]
    total = [[0.0] * k for _ in names]
    for doc in docs:
        at = [n for n, t in enumerate(names) if t in doc]
        if not at:
            continue
        count = [doc[names[n]] for n in at]
        gamma = [1 / k + sum(count) / k] * k
        for _ in range(100):
            theta = [math.exp(psi(g) - psi(sum(gamma))) for g in gamma]
            norm = [sum(beta[n][j] * theta[j] for j in range(k)) + 1e-100 for n in at]
            new = [1 / k + theta[j] * sum(c * beta[n][j] / z for n, c, z in zip(at, count, norm, strict=True)) for j in range(k)]
            moved = sum(abs(a - b) for a, b in zip(new, gamma, strict=True)) / k
            gamma = new
            if moved < 1e-3:
                break
        theta = [math.exp(psi(g) - psi(sum(gamma))) for g in gamma]
        for n, c in zip(at, count, strict=True):
            z = sum(beta[n][j] * theta[j] for j in range(k)) + 1e-100
            for j in range(k):
                total[n][j] += c * theta[j] * beta[n][j] / z
    rho = (1024 + batch + 1) ** -0.51
    used = sum(1 for d in docs if any(t in d for t in names))
    return {
        t: [lam[n][j] * (1 - rho) + (1 / k + corpus / used * total[n][j]) * rho for j in range(k)] for n, t in enumerate(names)
    }


def test_digamma():
    from repotide.operators.online_topics import digamma

    euler = 0.57721566490153286
    assert digamma([1.0, 2.0, 0.5, 10.0]) == pytest.approx([-euler, 1 - euler, -euler - 1.3862943611198906, 2.2517525890667211])


def test_one_step_equals_numbers_written_out(spark, repos, tmp_path):
    from collections import Counter

    from repotide.operators import online_topics
    from repotide.operators.vocabulary import counted_terms

    texts = ["a b b c", "a a d", "c d d e", "zz", "b c"]
    df = repos(*[{"description": t} for t in texts])
    names, k = ["a", "b", "c", "d", "e"], 3
    weights = {t: [0.5 + 0.1 * n + 0.07 * ((n * 5 + j * 3) % 7) for j in range(k)] for n, t in enumerate(names)}
    model = spark.createDataFrame([("Python", t, w) for t, w in weights.items()], online_topics.MODEL)
    frequencies = df.select("language", "id", counted_terms(("none",)).alias("terms")).repartition(3)
    summed = online_topics.statistics(frequencies, model, 1 / k)
    corpus = spark.createDataFrame([("Python", 40)], "language string, corpus long")
    found = {r.term: r.weights for r in online_topics.step(model, summed, 2, corpus, 1 / k).collect()}
    expected = numpy_step([Counter(t.split()) for t in texts], weights, 2, 40, k)
    assert found.keys() == expected.keys()
    for term, w in expected.items():
        assert found[term] == pytest.approx(w, rel=1e-5)


def test_topics_go_on_from_the_model_before(spark, repos, tmp_path):
    from repotide.streaming import topics as live

    words = {0: "api server cloud", 1: "game sprite pixel"}
    batch = lambda n: repos(*[{"id": 100 * n + m, "seq": 100 * n + m, "description": " ".join([words[m % 2]] * 3)} for m in range(12)])
    path = str(tmp_path / "topics")
    for n in range(4):
        live.fold_topics(batch(n), path, n, k=2)
    model = lambda: rows(snapshots.read_latest(spark, f"{path}/model").drop("version"))
    before = model()
    live.fold_topics(batch(3), path, 3, k=2)
    assert [r[:2] for r in model()] == [r[:2] for r in before]
    for a, b in zip(model(), before, strict=True):
        assert a[2] == pytest.approx(b[2])
    top = live.current_topics(spark, path, 3).collect()
    assert {r.language for r in top} == {"Python"} and {r.topic_id for r in top} == {0, 1}
    live.fold_topics(repos({"id": 900, "description": "lone", "language": "Java"}), path, 4, k=2)
    assert {r[0] for r in model()} == {"Python"} and len(model()) == 6
    assert live.current_topics(spark, str(tmp_path / "none")) is None


def test_console_of_a_stream(spark, events, tmp_path):
    """Every micro-batch reaches Spark's console sink; what the JVM prints is not captured here."""
    source = write_parts(events, str(tmp_path), 2)
    job = finish(refresh.console(stream_of(spark, events, source), str(tmp_path / "c")))
    assert "Console" in job.recentProgress[0]["sink"]["description"]
    assert sum(p["numInputRows"] for p in job.recentProgress) == events.count()


def test_history_in_few_folders(spark, tmp_path):
    inbox, table, path = tmp_path / "inbox", str(tmp_path / "landed"), str(tmp_path / "history")
    for n in range(9):
        write_lines(inbox, f"{n}.json", *[record(k, 10 * n + k) for k in range(n % 3 + 1)], "bad")
        finish(landing.land(ndjson.stream_lines(spark, path=str(inbox)), table, str(tmp_path / "c1")))
        finish(landing.maintain_history(spark, table, path, str(tmp_path / "c2")))
    kept, every = landing.history(spark, path), landing.landed(spark, table)
    columns = ("id", "seq", "name", "batch", "batch_time")
    assert rows(kept, *columns) == rows(every.where("not bad"), *columns)
    assert rows(landing.batch_history(kept), "id", "seq") == rows(landing.batch_history(every), "id", "seq")
    assert len(os.listdir(table)) >= 9 and len(tiers.folders(spark, path)) == 2
