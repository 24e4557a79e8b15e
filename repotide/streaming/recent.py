"""Recent pushes per batch, from a stream in any order.

A streaming aggregation keeps the first version of each repository in each batch. Its updates
are written per micro-batch; a reader takes the latest version of each (batch, repository) and
counts. So a late row or a batch that arrives over several micro-batches changes the counts of
its own batch, no batch is left out, and a repeated micro-batch replaces its own rows. State
holds one row per batch and repository; `late` bounds it where a producer promises a delay.
"""

from pyspark.sql import functions as F

from repotide.contract import BATCH_INTERVAL, LANGUAGES, RECENT_PUSH_AGE
from repotide.operators.counts import recent_push_counts, recent_push_history
from repotide.operators.state import assign_batch
from repotide.scratch import read_existing
from repotide.streaming.run import start, with_rocksdb

PUSHES = "batch_time timestamp, id long, seq long, language string, pushed_at timestamp"


def maintain_pushes(stream, path, checkpoint, late=None, interval=None):
    """Write the first push of each repository in each `batch_time` to the table at `path`."""
    narrow = with_rocksdb(stream).select("batch_time", "id", "seq", "language", "pushed_at")
    if late:
        narrow = narrow.withWatermark("batch_time", late)
    firsts = narrow.groupBy("batch_time", "id").agg(
        F.min("seq").alias("seq"),
        F.min_by("language", "seq").alias("language"),
        F.min_by("pushed_at", "seq").alias("pushed_at"),
    )

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start(firsts.writeStream.outputMode("update").foreachBatch(write), checkpoint, interval)


def replayed(stream, interval=BATCH_INTERVAL):
    """Rows without a batch of their own, in tumbling batches by push time."""
    return assign_batch(stream, interval)


def pushes(spark, path, since=None):
    """Rows unique by (batch_time, id), as they stand now; `since` prunes older batches."""
    rows = read_existing(spark, path, f"{PUSHES}, batch_id long")
    if rows is None:
        return spark.createDataFrame([], PUSHES)
    if since is not None:
        rows = rows.where(F.col("batch_time") >= F.lit(since))
    return rows.groupBy("batch_time", "id").agg(
        *[F.max_by(c, "batch_id").alias(c) for c in ("seq", "language", "pushed_at")]
    )


def recent_counts(spark, path, max_age=RECENT_PUSH_AGE):
    return recent_push_counts(pushes(spark, path), max_age)


def recent_history(spark, path, languages=LANGUAGES, max_age=RECENT_PUSH_AGE, since=None):
    """The zero-filled counts of each batch."""
    return recent_push_history(pushes(spark, path, since), max_age, languages)
