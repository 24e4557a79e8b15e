"""Counts and averages per language."""

from pyspark.sql import functions as F

from repotide.contract import AVERAGE_DIGITS, LANGUAGES, RECENT_PUSH_AGE
from repotide.functions.expressions import small_table, target_language


def available_languages(repos):
    return repos.where(F.col("language") != "").select("language").distinct()


def total_count_by_language(repos):
    """Expects repositories that are already unique."""
    return repos.groupBy("language").agg(F.count("*").alias("count"))


def avg_stars_by_language(repos, digits=AVERAGE_DIGITS):
    return repos.groupBy("language").agg(
        F.round(F.avg("stargazers_count"), digits).alias("avg_stargazers_count")
    )


def language_totals(repos):
    """(language, repos, stars, rated): sums that can be added up over batches."""
    return repos.groupBy("language").agg(
        F.count("*").alias("repos"),
        F.sum("stargazers_count").alias("stars"),
        F.count("stargazers_count").alias("rated"),
    )


def counts_of_totals(totals):
    return totals.select("language", F.col("repos").alias("count"))


def averages_of_totals(totals, digits=AVERAGE_DIGITS):
    average = F.round(F.col("stars") / F.col("rated"), digits)
    return totals.select("language", average.alias("avg_stargazers_count"))


def zero_fill_when_empty(result, value, languages=LANGUAGES):
    """Every target language with 0, but only if `result` has no row at all."""
    zeros = small_table(result.sparkSession, languages, "language").where(~result.exists())
    zero = F.lit(0).cast(result.schema[value].dataType)
    return result.unionByName(zeros.withColumn(value, zero))


def zero_fill_batches(per_batch, languages=LANGUAGES):
    """For each batch, every missing target language with 0; other languages are kept.

    `per_batch` has at least one row for each batch. The zeros are added as rows and summed
    in, so no join is needed.
    """
    entry = lambda language, count: F.struct(
        language.alias("language"), count.cast("long").alias("count")
    )
    zeros = [entry(F.lit(x), F.lit(0)) for x in languages]
    entries = F.array(entry(F.col("language"), F.col("count")), *zeros)
    return (
        per_batch.select("batch_time", F.inline(entries))
        .groupBy("batch_time", "language")
        .agg(F.sum("count").alias("count"))
        .where((F.col("count") > 0) | target_language(languages))
    )


def recently_pushed(max_age=RECENT_PUSH_AGE):
    """Pushed at most `max_age` before the batch time; a later push passes as well."""
    return F.col("batch_time") - F.col("pushed_at") <= F.expr(f"INTERVAL {max_age}")


def _pushes_per_batch(batched, max_age):
    """Also keeps a batch in which nothing was pushed recently, with counts of 0."""
    return batched.groupBy("batch_time", "language").agg(
        F.count_if(recently_pushed(max_age)).alias("count")
    )


def recent_push_counts(batched, max_age=RECENT_PUSH_AGE):
    """Recently pushed repositories per batch and language. Expects rows unique per batch."""
    return _pushes_per_batch(batched, max_age).where(F.col("count") > 0)


def recent_push_history(batched, max_age=RECENT_PUSH_AGE, languages=LANGUAGES):
    """Recent counts of every batch, zero-filled, with the label shown to users."""
    return zero_fill_batches(_pushes_per_batch(batched, max_age), languages).withColumn(
        "batch_label", F.date_format("batch_time", "HH:mm:ss")
    )


def batch_metrics(batched, interval):
    """Per batch: seconds since the first batch began, and input rows."""
    per_batch = batched.groupBy("batch_time").agg(F.count("*").alias("input_rows"))
    start = per_batch.agg(F.min("batch_time")).scalar() - F.expr(f"INTERVAL {interval}")
    uptime = F.unix_timestamp("batch_time") - F.unix_timestamp(start)
    return per_batch.withColumn("uptime_seconds", uptime)
