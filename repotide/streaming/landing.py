"""First job: lines to a Parquet table of records, one partition per micro-batch.

The table is the batch history. Bad lines go to its `bad` partitions in the same write. A
repeated micro-batch overwrites its own partition.

Records whose producer sends no sequence number get one here, once, in the order of their
arrival: the number of the micro-batch, then the position of the line in the source.
"""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from repotide.contract import REPO_SCHEMA
from repotide.operators.state import dedup_within_batch
from repotide.scratch import read_existing, temporary, write_table
from repotide.sources import tiers
from repotide.sources.ndjson import POSITION, parse_lines
from repotide.streaming.run import start

# Lines of a micro-batch that its sequence numbers have room for.
_BATCH_BITS = 40
_ROW = (1 << 33) - 1


def stamp_batch(stream):
    """Each row gets the time its micro-batch is processed; one value per micro-batch."""
    return stream.withColumn("batch_time", F.current_timestamp())


def with_sequence(records, batch_id):
    """Fill missing sequence numbers in order of arrival; unique over all micro-batches.

    The sorted rows are written before they are numbered, so that a lost executor cannot
    renumber them. Numbers of a sorted partition start after the rows of those before it.
    """
    order = [c for c in (POSITION,) if c in records.columns]
    ordered = records.withColumn("_at", F.monotonically_increasing_id()).orderBy(*order, "_at")
    rows = write_table(ordered.withColumn("_at", F.monotonically_increasing_id()), "arrivals")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()  # one row per partition
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    number = F.lit(batch_id << _BATCH_BITS) + F.col("_start") + F.col("_at").bitwiseAND(F.lit(_ROW))
    numbered = rows.join(F.broadcast(starts), "_part").withColumn("seq", F.coalesce("seq", number))
    return numbered.drop("_part", "_start", "_at")


def land(lines, table, checkpoint, schema=REPO_SCHEMA, interval=None):
    def write(batch, batch_id):
        spark = batch.sparkSession
        with temporary(spark):
            parsed = parse_lines(batch, schema)
            if "seq" in schema.names:
                parsed = with_sequence(parsed, batch_id)
            now = F.lit(datetime.now(timezone.utc))
            rows = parsed.drop(POSITION).withColumn("batch_time", now)
            rows = rows.withColumn("line", F.when(F.col("bad"), F.col("line")))
            writer = rows.write.mode("overwrite").partitionBy("bad")
            writer.parquet(f"{table}/batch={batch_id:012d}")

    return start(lines.writeStream.foreachBatch(write), checkpoint, interval)


def _table_schema(schema):
    return schema.add("line", "string").add("batch_time", "timestamp").add("batch", "string").add("bad", "boolean")


def landed(spark, table, schema=REPO_SCHEMA):
    return spark.read.schema(_table_schema(_copy(schema))).parquet(table)


def landed_stream(spark, table, schema=REPO_SCHEMA):
    return spark.readStream.schema(_table_schema(_copy(schema))).parquet(table)


def wait_for_table(spark, table, job, schema=REPO_SCHEMA):
    """Return once the landing job has written its first micro-batch, or has ended."""
    while job.isActive and read_existing(spark, table, schema) is None:
        job.awaitTermination(1)


def _copy(schema):
    return type(schema)(list(schema.fields))


def _history_schema(schema):
    return _copy(schema).add("batch_time", "timestamp").add("batch", "string")


def maintain_history(spark, table, history, checkpoint, schema=REPO_SCHEMA, interval=None):
    """Copy good records to a table of few folders, however many micro-batches there were.

    Other streams follow the files of the landed table, so its folders stay as they are; readers
    of the whole history open the logarithmic number of folders of this one instead.
    """

    def fold(rows, batch_id):
        tiers.append(rows, history, batch_id)

    good = landed_stream(spark, table, schema).where(~F.col("bad")).select(*_history_schema(schema).names)
    return start(good.writeStream.foreachBatch(fold), checkpoint, interval)


def history(spark, path, schema=REPO_SCHEMA):
    """The rows of `maintain_history`, for `batch_history`."""
    return tiers.read(spark, path, _history_schema(schema))


def quarantine(table_rows):
    return table_rows.where("bad").select("batch_time", "line")


def batch_history(table_rows):
    """Repositories of each batch, unique within it."""
    good = table_rows.where(~F.col("bad")) if "bad" in table_rows.columns else table_rows
    return dedup_within_batch(good.drop("line", "bad", "batch"))


def batch_metrics(table_rows):
    """(batch, input_rows, bad_rows, uptime_seconds) of every landed micro-batch; uptime counts
    from the first one. Read from the table, so it reaches as far back as the table does."""
    batches = table_rows.groupBy(F.col("batch").cast("long").alias("batch")).agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("bad")).alias("bad_rows"),
        F.min("batch_time").alias("batch_time"),
    )
    first = table_rows.agg(F.min("batch_time")).scalar()
    uptime = F.unix_timestamp("batch_time") - F.unix_timestamp(first)
    return batches.withColumn("uptime_seconds", uptime).drop("batch_time")
