"""Counts of each micro-batch taken while it runs, without reading it again.

`observe` adds aggregates to a running query that Spark computes along with the rows; a listener
writes what each micro-batch reports to a small table. `landing.batch_metrics` counts the landed
table instead, which costs a scan. Both give (batch, input_rows, bad_rows, uptime_seconds).

A micro-batch that is repeated after a failure reports again and replaces its own row. A report is
lost if the driver dies between a micro-batch and its report; `missing` lists such batches, which
the landed table still has.
"""

import threading

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from repotide.scratch import read_existing

NAME = "batch_metrics"
METRICS = "input_rows long, bad_rows long, started timestamp"


def observed(parsed):
    """A parsed stream that reports its rows and bad rows under NAME."""
    return parsed.observe(NAME, F.count(F.lit(1)).alias("input_rows"), F.count_if(F.col("bad")).alias("bad_rows"))


class MetricsWriter(StreamingQueryListener):
    """Writes each report of NAME below `path`, a folder per micro-batch."""

    def __init__(self, spark, path, name=None):
        self.spark, self.path, self.name = spark, path, name
        self.done, self.changed = -1, threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        row = progress.observedMetrics.get(NAME)
        if row is None or (self.name is not None and progress.name != self.name):
            return
        if row["input_rows"] or progress.numInputRows:
            started = F.to_timestamp(F.lit(progress.timestamp))
            numbers = [F.lit(row[c]).cast("long").alias(c) for c in ("input_rows", "bad_rows")]
            report = self.spark.range(1).select(*numbers, started.alias("started"))
            report.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={progress.batchId}")
        with self.changed:
            self.done = max(self.done, progress.batchId)
            self.changed.notify_all()

    def wait(self, batch, seconds=60):
        """Until the report of `batch` is written; reports come after their micro-batch."""
        with self.changed:
            return self.changed.wait_for(lambda: self.done >= batch, seconds)


def metrics(spark, path):
    """(batch, input_rows, bad_rows, uptime_seconds) of every reported micro-batch."""
    rows = read_existing(spark, path, f"{METRICS}, batch long")
    if rows is None:
        return spark.createDataFrame([], "batch long, input_rows long, bad_rows long, uptime_seconds long")
    first = rows.agg(F.min("started")).scalar()
    uptime = F.unix_timestamp("started") - F.unix_timestamp(first)
    return rows.select("batch", "input_rows", "bad_rows", uptime.alias("uptime_seconds"))


def missing(reported, landed):
    """The micro-batches of a landed table that have no report."""
    batches = landed.select(F.col("batch").cast("long").alias("batch")).distinct()
    return batches.join(reported, "batch", "left_anti")
