"""Recent pushes as an append-only result: each batch window is counted once, when it has closed.

`recent` keeps the counts of every batch open for late rows, and its readers reduce the table of
pushes again. Here the producer promises a delay: rows more than `late` behind the newest push are
dropped. A window closes when the watermark passes its end; its first pushes leave the state, are
counted, and are never read again. State holds the open windows alone, and the result is final.
"""

from pyspark.sql import functions as F

from repotide.contract import BATCH_INTERVAL, RECENT_PUSH_AGE
from repotide.operators.counts import recent_push_counts
from repotide.scratch import read_existing
from repotide.streaming.run import start, with_rocksdb

CLOSED = "batch_time timestamp, language string, count long"


def first_pushes(stream, late, interval=BATCH_INTERVAL):
    """The first version of each repository in each window of `interval`, once it has closed."""
    narrow = with_rocksdb(stream).select("id", "seq", "language", "pushed_at").withWatermark("pushed_at", late)
    firsts = narrow.groupBy(F.window("pushed_at", interval), "id").agg(
        F.min("seq").alias("seq"),
        F.min_by("language", "seq").alias("language"),
        F.min_by("pushed_at", "seq").alias("pushed"),
    )
    batch = F.col("window")["end"].alias("batch_time")
    return firsts.select(batch, "id", "seq", "language", F.col("pushed").alias("pushed_at"))


def maintain_closed_counts(stream, path, checkpoint, late, interval=BATCH_INTERVAL, max_age=RECENT_PUSH_AGE, trigger=None):
    """Append (batch_time, language, count) of each closed window to the table at `path`.

    All groups of a window leave the state in the same micro-batch, so its counts are complete
    there. A repeated micro-batch replaces its own partition.
    """

    def write(rows, batch_id):
        counted = recent_push_counts(rows, max_age)
        counted.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    closed = first_pushes(stream, late, interval)
    return start(closed.writeStream.outputMode("append").foreachBatch(write), checkpoint, trigger)


def closed_counts(spark, path):
    """The counts of all closed windows; each stands in one place and is not reduced again."""
    rows = read_existing(spark, path, f"{CLOSED}, batch_id long")
    return spark.createDataFrame([], CLOSED) if rows is None else rows.drop("batch_id")


def state_rows(query):
    """Rows that the state of a finished query holds after each of its micro-batches."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
