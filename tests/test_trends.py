from datetime import datetime

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from repotide.operators import display, trends
from repotide.plans.report import trend_section

AS_OF = datetime(2024, 7, 1)


def history(repos, counts):
    """counts: month -> number of repositories created in it."""
    return repos(
        *[
            {"created_at": at(f"{month}-05 12:00:00"), "stargazers_count": 3}
            for month, n in counts.items()
            for _ in range(n)
        ]
    )


def report(repos, *numbers, months=None):
    months = months or [f"2024-{m:02d}" for m in range(1, len(numbers) + 1)]
    return trend_section(history(repos, dict(zip(months, numbers))), AS_OF).first()


@pytest.mark.parametrize(
    "numbers, growth, direction",
    [
        ((2, 3, 4), [0.0, 50.0, 33.33], "growing"),
        ((10, 5, 2), [0.0, -50.0, -60.0], "declining"),
        ((4, 8), [0.0, 100.0], "insufficient_data"),
    ],
)
def test_growth_and_direction(repos, numbers, growth, direction):
    found = report(repos, *numbers)
    assert [m.growth_rate for m in found.monthly_data] == growth
    assert found.trend_direction == direction


def test_missing_month_is_skipped(repos):
    found = report(repos, 4, 5, 4, months=["2024-01", "2024-02", "2024-04"])
    assert [m.growth_rate for m in found.monthly_data] == [0.0, 25.0, -20.0]
    assert found.trend_direction == "stable"
    assert found.peak_month.month == "2024-02"


def test_earliest_of_equal_peaks(repos):
    assert report(repos, 3, 3, 1).peak_month.month == "2024-01"


def test_six_of_eight_months_are_shown(repos):
    found = report(repos, *[1] * 8)
    assert [m.month for m in found.monthly_data] == [f"2024-{m:02d}" for m in range(3, 9)]
    assert found.total_months == 8


def test_synthetic_dates(repos):
    dated = trends.synthetic_dates(repos(*[{}] * 7), AS_OF).orderBy("seq")
    months = [r.m for r in dated.select(F.date_format("created_at", "yyyy-MM").alias("m")).collect()]
    assert months == [f"2024-{m}" for m in ("07", "06", "05", "04", "03", "02", "07")]


def test_no_synthetic_date_beside_a_real_one(repos):
    df = repos({"created_at": at("2020-02-03 00:00:00")}, {})
    assert rows(trends.synthetic_dates(df, AS_OF), "id") == []
    assert trend_section(df, AS_OF).first().total_months == 1


def test_null_stars_count_as_zero(repos):
    df = repos(
        {"created_at": at("2024-01-01 00:00:00"), "stargazers_count": None},
        {"created_at": at("2024-01-02 00:00:00"), "stargazers_count": 3},
    )
    trend = trends.monthly_trend(trends.dated_rows(df))
    assert rows(trend, "total_stars", "avg_stars") == [(3, 1.5)]


def test_colors_and_arrows(spark):
    directions = spark.createDataFrame([(d,) for d in ("growing", "declining", "stable", "insufficient_data")], "trend_direction string")
    assert rows(display.trend_display(directions)) == [
        ("declining", "red"),
        ("growing", "green"),
        ("insufficient_data", "orange"),
        ("stable", "orange"),
    ]
    rates = spark.createDataFrame([(2.5,), (-3.0,), (0.0,)], "growth_rate double")
    assert rows(display.growth_arrow(rates)) == [(-3.0, "down", 3.0), (0.0, "flat", 0.0), (2.5, "up", 2.5)]
