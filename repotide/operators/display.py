"""Results in the shape and wording a dashboard or console shows."""

from pyspark.sql import functions as F

from repotide.contract import TOP_ENTITIES_SHOWN, TOPIC_WORDS_SHOWN


def activity_series(history, languages):
    """One column per language over the ordered batch times."""
    return history.groupBy("batch_time").pivot("language", list(languages)).agg(F.first("count"))


def aligned_series(result, value):
    """Languages and values as two aligned lists; one entry per language."""
    ordered = F.array_sort(F.collect_list(F.struct("language", value)))
    return result.agg(ordered.alias("s")).select(
        F.col("s.language").alias("languages"), F.col(f"s.{value}").alias("values")
    )


def topic_display(nested, shown=TOPIC_WORDS_SHOWN):
    """Topic numbers from 1, and the first words as text."""
    return nested.select(
        "language",
        (F.col("topic_id") + 1).alias("topic_number"),
        F.array_join(F.slice("top_words", 1, shown), ", ").alias("formatted_words"),
    )


def entity_display(grid, shown=TOP_ENTITIES_SHOWN):
    """Types without entities are dropped; the first entities as `name(count)`."""
    first = F.slice("entities", 1, shown)
    text = F.transform(
        first, lambda e: F.concat(e["name"], F.lit("("), e["count"].cast("string"), F.lit(")"))
    )
    return grid.where(F.size("entities") > 0).select(
        "language", "entity_type", F.array_join(text, ", ").alias("line")
    )


def similarity_display(nested):
    return nested.select("language", "similar_pairs", "total_repos_analyzed")


def trend_display(trend):
    color = (
        F.when(F.col("trend_direction") == "growing", "green")
        .when(F.col("trend_direction") == "declining", "red")
        .otherwise("orange")
    )
    return trend.withColumn("trend_color", color)


def growth_arrow(months):
    """up / down / flat, and the growth without its sign."""
    rate = F.col("growth_rate")
    arrow = F.when(rate > 0, "up").when(rate < 0, "down").otherwise("flat")
    return months.withColumn("arrow", arrow).withColumn("change", F.abs(rate))


def word_lines(nested):
    """`word, count` lines of each language in one text."""
    line = lambda e: F.concat_ws(", ", e["word"], e["count"].cast("string"))
    return nested.select(
        "language", F.array_join(F.transform("top_ten_words", line), "\n").alias("lines")
    )


def sample_count_lines(totals, averages):
    """`language:count:average`; one row per language on both sides."""
    text = [F.col(c).cast("string") for c in ("language", "count", "avg_stargazers_count")]
    return totals.join(averages, "language").select(F.concat_ws(":", *text).alias("line"))


def sample_word_lines(nested):
    """`language:(word,count),...`."""
    pair = lambda e: F.concat(
        F.lit("("), e["word"], F.lit(","), e["count"].cast("string"), F.lit(")")
    )
    words = F.array_join(F.transform("top_ten_words", pair), ",")
    return nested.select(F.concat_ws(":", "language", words).alias("line"))


# The wording of the console lines that the next functions make.


def topic_lines(nested):
    words = F.array_join("top_words", ", ")
    return nested.select(
        "language", F.format_string("Topic %d: %s", "topic_id", words).alias("line")
    )


def pair_lines(flat):
    score = F.col("similarity").cast("string")
    return flat.select(
        "language",
        F.concat("repo1", F.lit(" ↔ "), "repo2", F.lit(": "), score).alias("line"),
    )


def trend_lines(report):
    return report.select(
        "language",
        F.format_string(
            "Trend Direction: %s; Recent Months: %d analyzed; Peak Month: %s (%d repos)",
            "trend_direction",
            "total_months",
            "peak_month.month",
            "peak_month.repo_count",
        ).alias("line"),
    )
