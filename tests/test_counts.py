from conftest import at, rows
from pyspark.sql import functions as F

from repotide.operators import counts, state

BATCH = at("2024-01-01 00:01:00")


def batched(repos, *records):
    """Records with a batch time; push and batch time are BATCH unless given."""
    times = F.array(*[F.lit(r.get("batch_time", BATCH)) for r in records])
    plain = [{k: v for k, v in r.items() if k != "batch_time"} for r in records]
    df = repos(*[{"pushed_at": BATCH, **r} for r in plain])
    return df.withColumn("batch_time", F.get(times, F.col("seq").cast("int")))


def test_first_version_wins(repos):
    df = repos({"id": 1, "stargazers_count": 5}, {"id": 1, "stargazers_count": 9}, {"id": 2, "stargazers_count": 1})
    assert rows(state.dedup_first_seen(df), "id", "stargazers_count") == [(1, 5), (2, 1)]


def test_first_version_may_hold_nulls(repos):
    df = repos({"id": 1, "description": None}, {"id": 1, "description": "later"})
    assert rows(state.dedup_first_seen(df), "id", "description") == [(1, None)]


def test_push_age_is_inclusive_and_future_passes(repos):
    df = batched(
        repos,
        {"pushed_at": at("2024-01-01 00:00:00")},
        {"pushed_at": at("2023-12-31 23:59:59")},
        {"pushed_at": at("2024-01-01 00:01:05")},
    )
    assert rows(df.where(counts.recently_pushed()), "id") == [(0,), (2,)]


def test_first_version_in_batch_decides_the_age(repos):
    df = batched(
        repos,
        {"id": 7, "pushed_at": at("2023-12-31 23:59:30")},
        {"id": 7, "pushed_at": at("2024-01-01 00:00:50")},
    )
    assert rows(counts.recent_push_counts(state.dedup_within_batch(df))) == []


def test_counted_once_in_each_batch_and_once_ever(repos):
    later = at("2024-01-01 00:02:00")
    df = batched(repos, {"id": 7}, {"id": 7, "batch_time": later, "pushed_at": later}, {"id": 7})
    pushes = counts.recent_push_counts(state.dedup_within_batch(df))
    assert rows(pushes, "batch_time", "count") == [(BATCH, 1), (later, 1)]
    assert rows(counts.total_count_by_language(state.dedup_first_seen(df))) == [("Python", 1)]


def test_missing_targets_are_filled_and_others_kept(repos):
    df = batched(repos, {"language": "Go"}, {"language": "Python"}, {"language": "JavaScript"})
    history = counts.recent_push_history(df)
    assert rows(history, "language", "count") == [
        ("Go", 1),
        ("Java", 0),
        ("JavaScript", 1),
        ("Python", 1),
    ]
    assert {r.batch_label for r in history.collect()} == {"00:01:00"}


def test_batch_without_recent_push_is_all_zero(repos):
    old = at("2020-01-01 00:00:00")
    df = batched(repos, {"language": "Go", "pushed_at": old}, {"pushed_at": old})
    assert rows(counts.recent_push_history(df), "language", "count") == [
        ("Java", 0),
        ("JavaScript", 0),
        ("Python", 0),
    ]


def test_zero_fill_only_when_there_is_nothing(repos):
    from repotide.plans.report import count_sections, word_section

    empty = repos().where("false")
    zeros = [("Java", 0), ("JavaScript", 0), ("Python", 0)]
    assert rows(count_sections(empty)["req1"]) == zeros
    assert rows(count_sections(empty)["req3"]) == zeros
    assert rows(word_section(empty)) == [("Java", []), ("JavaScript", []), ("Python", [])]
    some = repos({"description": "a word"})
    assert rows(count_sections(some)["req1"]) == [("Python", 1)]
    assert [r.language for r in word_section(some).collect()] == ["Python"]


def test_average_rounds_half_up(repos):
    df = repos(
        {"language": "a", "stargazers_count": 1},
        {"language": "a", "stargazers_count": 2},
        {"language": "b", "stargazers_count": 1},
        {"language": "b", "stargazers_count": 1},
        {"language": "b", "stargazers_count": 2},
    )
    assert rows(counts.avg_stars_by_language(df)) == [("a", 1.5), ("b", 1.33)]


def test_available_languages_skip_empty_names(repos):
    df = repos({"language": ""}, {"language": None}, {"language": "Go"}, {"language": "Go"})
    assert rows(counts.available_languages(df)) == [("Go",)]


def test_assigned_batch_is_the_end_of_the_interval(repos):
    df = repos({"pushed_at": at("2024-01-01 00:00:00")}, {"pushed_at": at("2024-01-01 00:00:59")})
    assert rows(state.assign_batch(df), "batch_time") == [(BATCH,), (BATCH,)]
