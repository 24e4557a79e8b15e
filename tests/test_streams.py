import json
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from repotide.app import run
from repotide.operators import counts, state
from repotide.plans import tables
from repotide.plans.registry import DAY, EVENT_SCHEMA, HALF_DAY
from repotide.sources import ndjson, snapshots
from repotide.streaming import landing, lifetime, recent
from repotide.streaming.run import finish, start

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return tables.events(spark, SF).select(*EVENT_SCHEMA.names)


def write_parts(df, folder, parts):
    """The rows in `parts` files, in arrival order."""
    total = df.agg(F.max("seq")).first()[0] + 1
    for n in range(parts):
        low, high = total * n // parts, total * (n + 1) // parts
        one = f"{folder}/tmp{n}"
        df.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.parquet(one)
        name = next(f for f in os.listdir(one) if f.endswith(".parquet"))
        os.makedirs(f"{folder}/in", exist_ok=True)
        shutil.copy(f"{one}/{name}", f"{folder}/in/{n:02d}.parquet")
        os.utime(f"{folder}/in/{n:02d}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))
    return f"{folder}/in"


def stream_of(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_totals_equal_the_batch_form(spark, events, tmp_path, parts):
    source = write_parts(events, str(tmp_path), parts)
    path, checkpoint = str(tmp_path / "totals"), str(tmp_path / "checkpoint")
    finish(lifetime.maintain_totals(stream_of(spark, events, source), path, checkpoint))
    unique = state.dedup_first_seen(events)
    assert rows(lifetime.lifetime_counts(spark, path)) == rows(counts.total_count_by_language(unique))
    assert rows(lifetime.lifetime_averages(spark, path)) == rows(counts.avg_stars_by_language(unique))


def test_restart_with_duplicates_changes_nothing(spark, events, tmp_path):
    source = write_parts(events, str(tmp_path), 2)
    path, checkpoint = str(tmp_path / "totals"), str(tmp_path / "checkpoint")
    run = lambda: finish(
        lifetime.maintain_totals(stream_of(spark, events, source), path, checkpoint)
    )
    run()
    before = rows(lifetime.lifetime_counts(spark, path))
    changed = events.withColumn("language", F.lit("other")).withColumn("seq", F.col("seq") - 10**6)
    changed.coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(lifetime.lifetime_counts(spark, path)) == before


@pytest.mark.parametrize("parts", [1, 3, 10])
@pytest.mark.parametrize("backwards", [False, True])
def test_recent_counts_equal_the_batch_form(spark, events, tmp_path, parts, backwards):
    """In any number of micro-batches, and with the latest rows first."""
    source = write_parts(events, str(tmp_path), parts)
    if backwards:
        for n, name in enumerate(sorted(os.listdir(source), reverse=True)):
            os.utime(f"{source}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))
    path = str(tmp_path / "pushes")
    stream = recent.replayed(stream_of(spark, events, source), DAY)
    finish(recent.maintain_pushes(stream, path, str(tmp_path / "checkpoint")))
    batch = state.dedup_within_batch(state.assign_batch(events, DAY))
    columns = ("batch_time", "language", "count")
    assert rows(recent.recent_counts(spark, path, HALF_DAY), *columns) == rows(counts.recent_push_counts(batch, HALF_DAY), *columns)
    filled = recent.recent_history(spark, path, ("click", "fork"), HALF_DAY)
    assert rows(filled, *columns) == rows(counts.recent_push_history(batch, HALF_DAY, ("click", "fork")), *columns)


def record(id, seq, **values):
    return json.dumps(
        {"id": id, "seq": seq, "name": f"r{id}", "language": "Python", "description": None,
         "stargazers_count": 0, "pushed_at": "2024-01-01T00:00:10Z", **values}
    )


def write_lines(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def test_lines_to_snapshot(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    words = "api data cloud server web".split()

    def run_once():
        run(spark, ndjson.stream_lines(spark, path=str(inbox)), out, interval=None)
        payload = snapshots.latest_snapshot(spark, f"{out}/snapshot").first().payload
        return landing.batch_metrics(landed()).collect(), json.loads(payload)

    landed = lambda: landing.landed(spark, f"{out}/landed")

    write_lines(
        inbox, "a.json", record(1, 2, stargazers_count=9, description="late"),
        record(1, 1, stargazers_count=5, description="docker api api"), "not json",
        *[record(n, n, description=f"{words[n % 5]} {words[n % 3]}", stargazers_count=1) for n in range(10, 20)],
    )
    metrics, first = run_once()
    assert [tuple(m) for m in metrics] == [(0, 13, 1, 0)]
    assert rows(landing.quarantine(landed()), "line") == [("not json",)]
    assert first["req1"] == [{"language": "Python", "count": 11}]
    assert first["req3"] == [{"language": "Python", "avg_stargazers_count": 1.36}]
    assert sorted(first) == [f"req{n}" for n in range(1, 9)]

    write_lines(
        inbox, "b.json", record(1, 0, stargazers_count=100, description="api api api"),
        record(30, 30, language="Java", description="spring docker"),
    )
    _, second = run_once()
    assert {r["language"]: r["count"] for r in second["req1"]} == {"Java": 1, "Python": 11}
    repos = spark.read.parquet(f"{out}/repos")
    assert rows(repos.where("id = 1"), "stargazers_count") == [(5,)]
    top = {r["language"]: {w["word"]: w["count"] for w in r["top_ten_words"]} for r in second["req4"]}
    assert top["Java"] == {"spring": 1, "docker": 1}
    expected = repos.where("language = 'Python'").select("description").collect()
    api = sum(r.description.split().count("api") for r in expected)
    assert top["Python"]["api"] == api
    by_language = {r["language"]: r["entities"] for r in second["req6"]}
    assert by_language["Java"]["companies"] == [{"name": "docker", "count": 1}]
    assert landing.batch_history(landed()).count() == 13


LINE = '{"id":%d,"name":"a","language":"Python","description":null,"stargazers_count":%d,"pushed_at":"2024-01-01T00:00:%02dZ"}'


def test_lines_without_sequence_numbers_count_as_they_arrive(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "landed")
    land = lambda: finish(landing.land(ndjson.stream_lines(spark, path=str(inbox)), table, str(tmp_path / "c")))
    write_lines(inbox, "b.json", LINE % (1, 9, 30), LINE % (1, 5, 10), LINE % (1, 7, 20), LINE % (2, 1, 30), LINE % (2, 2, 30))
    land()
    write_lines(inbox, "a.json", LINE % (1, 3, 0), LINE % (3, 8, 0))
    land()
    landed = landing.landed(spark, table)
    assert rows(landing.batch_history(landed).where("seq < 100"), "id", "stargazers_count") == [(1, 9), (2, 1)]
    first = state.dedup_first_seen(landed.drop("line", "bad", "batch", "batch_time"))
    assert rows(first, "id", "stargazers_count") == [(1, 9), (2, 1), (3, 8)]
    assert landed.select("seq").distinct().count() == 7


def test_metrics_reach_back_to_the_first_batch(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "landed")
    for n in range(8):
        write_lines(inbox, f"{n}.json", *[record(k, 10 * n + k) for k in range(n + 1)], "bad")
        os.utime(inbox / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        lines = ndjson.stream_lines(spark, path=str(inbox), maxFilesPerTrigger=1)
        finish(landing.land(lines, table, str(tmp_path / "c")))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    metrics = sorted(landing.batch_metrics(landing.landed(spark, table)).collect())
    assert [(m.batch, m.input_rows, m.bad_rows) for m in metrics] == [(n, n + 2, 1) for n in range(8)]
    assert metrics[0].uptime_seconds == 0 and metrics[-1].uptime_seconds >= 0


def test_last_state_is_published_whatever_the_interval(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    for n in range(3):
        write_lines(inbox, f"{n}.json", record(n, n))
        run(spark, ndjson.stream_lines(spark, path=str(inbox)), out, interval=None, refresh_every=50)
        payload = json.loads(snapshots.latest_snapshot(spark, f"{out}/snapshot").first().payload)
        assert payload["req1"] == [{"language": "Python", "count": n + 1}]


def test_refreshes_leave_no_scratch_tables(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    from repotide.scratch import scratch_path

    folder = os.path.dirname(scratch_path(spark, "x"))
    sizes = []
    for n in range(3):
        write_lines(inbox, f"{n}.json", record(n, n, description="docker api"))
        run(spark, ndjson.stream_lines(spark, path=str(inbox)), out, interval=None)
        sizes.append(len(os.listdir(folder)) if os.path.isdir(folder) else 0)
    assert sizes[0] == sizes[-1]


def test_streams_read_tables_of_several_files(spark, tmp_path):
    """A table that is a folder gives the rows of the table that is one file."""
    from repotide.plans.registry import QUERIES

    spark.read.parquet(f"{SF}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_lifetime_counts", "stream_avg_stars", "stream_recent_counts"):
        found = rows(QUERIES[name](spark, str(tmp_path)))
        assert found and found == rows(QUERIES[name](spark, SF))


def test_streams_without_any_row(spark, events, tmp_path):
    events.limit(0).write.parquet(f"{tmp_path}/in")
    stream = lambda: stream_of(spark, events, f"{tmp_path}/in")
    finish(lifetime.maintain_totals(stream(), f"{tmp_path}/totals", f"{tmp_path}/c1"))
    assert rows(lifetime.lifetime_counts(spark, f"{tmp_path}/totals")) == []
    assert rows(lifetime.lifetime_averages(spark, f"{tmp_path}/totals")) == []
    finish(recent.maintain_pushes(recent.replayed(stream(), DAY), f"{tmp_path}/pushes", f"{tmp_path}/c2"))
    assert rows(recent.recent_counts(spark, f"{tmp_path}/pushes", HALF_DAY)) == []


def test_blocks_of_two_threads_keep_their_own_scratch_tables(spark):
    import threading

    from repotide.scratch import inherited, read_existing, temporary, write_table

    opened, ended, found = threading.Event(), threading.Event(), []

    def other():
        with temporary(spark):
            opened.set()
            ended.wait(60)
            found.append(write_table(spark.range(3), "theirs").count())

    thread = threading.Thread(target=other)
    with temporary(spark):
        thread.start()
        assert opened.wait(60)
        with temporary(spark):
            mine = write_table(spark.range(5), "inner")
            path = mine.inputFiles()[0].rsplit("/", 1)[0]
            workers = []
            worker = threading.Thread(target=inherited(lambda: workers.append(write_table(spark.range(2), "worker"))))
            worker.start()
            worker.join()
            started = workers[0].inputFiles()[0].rsplit("/", 1)[0]
        assert read_existing(spark, path) is None and read_existing(spark, started) is None
    ended.set()
    thread.join()
    assert found == [3]


def test_landing_and_refresh_side_by_side(spark, tmp_path):
    """The end of one job's block takes nothing from the other, in many rounds of both."""
    import threading

    from repotide.scratch import temporary, write_table

    def rounds(n, failures):
        try:
            for _ in range(6):
                with temporary(spark):
                    assert write_table(spark.range(n), f"rounds-{n}").count() == n
        except Exception as error:
            failures.append(error)

    failures = []
    threads = [threading.Thread(target=rounds, args=(n, failures)) for n in (7, 8, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert failures == []
