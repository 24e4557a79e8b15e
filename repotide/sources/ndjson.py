"""Newline-JSON records: read, parse, split off bad lines, write."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.contract import REPO_SCHEMA, WIRE_TIMESTAMP

CORRUPT = "_corrupt"
# Where a line stood in its source; sorts as the lines arrived.
POSITION = "_position"


def stream_lines(spark, source="text", **options):
    """An unbounded stream of lines as `value`, with the place each came from. Any source with
    a `value` column will do: a folder of text files (the default, replayable), Kafka, or a
    socket, which has no places."""
    read = spark.readStream.format(source).options(**options).load()
    value = F.col("value").cast("string").alias("value")
    if {"partition", "offset", "timestamp"} <= set(read.columns):
        return read.select(value, F.struct("timestamp", "partition", "offset").alias(POSITION))
    if source in ("text", "json", "parquet"):
        places = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "file_block_start")]
        return read.select(value, F.struct(*places).alias(POSITION))
    return read.select(value)


def parse_lines(lines, schema=REPO_SCHEMA):
    """The record's columns, the line itself, and `bad` for lines that are no usable record:
    not JSON, a value of the wrong type, no id, or no push time.

    A filter on `bad` would be pushed below a projection and parse each line again; it stays
    above a generator.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json("value", with_corrupt, options)
    carried = [c for c in lines.columns if c == POSITION]
    parsed = lines.select(F.col("value").alias("line"), *carried, F.inline(F.array(record)))
    required = [c for c in ("id", "pushed_at") if c in schema.names]
    bad = F.col(CORRUPT).isNotNull()
    for column in required:
        bad = bad | F.col(column).isNull()
    return parsed.withColumn("bad", bad).drop(CORRUPT)


def good_rows(parsed):
    return parsed.where(~F.col("bad")).drop("bad", "line")


def quarantined_lines(parsed):
    return parsed.where("bad").select("line")


def to_lines(records):
    """One JSON object per row as `value`; null fields are written, as the wire form does."""
    options = {"ignoreNullFields": "false", "timestampFormat": WIRE_TIMESTAMP}
    return records.select(F.to_json(F.struct("*"), options).alias("value"))


def write_lines(records, path):
    to_lines(records).write.mode("append").text(path)
