"""Small result tables of which only the latest version matters, and running totals.

A version is written into a folder of its own; a row in the `published` table then makes it
the latest. Readers follow that table, so they never meet a version that is being written, a
writer that dies in between leaves the version before in place, and writing a version twice
changes nothing. All but the last few versions are deleted.

Running totals are a published base version and one small table of deltas for each later
batch; every COMPACT_EVERY batches the deltas become part of a new base.
"""

from pyspark.sql import functions as F

from repotide.scratch import delete, read_existing

KEPT = 3
COMPACT_EVERY = 16


def write_version(df, path, version):
    """Write `df` as `version` of the table at `path` and make it the latest."""
    spark = df.sparkSession
    df.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite").parquet(
        f"{path}/data/{version}"
    )
    pointer = spark.range(1).select(F.lit(version).cast("long").alias("number"))
    pointer.write.mode("overwrite").parquet(f"{path}/published/number_{version}")
    for old in published(spark, path)[:-KEPT]:
        delete(spark, f"{path}/published/number_{old}")
        delete(spark, f"{path}/data/{old}")


def published(spark, path):
    """Numbers of the published versions, in order."""
    table = read_existing(spark, f"{path}/published/number_*", "number long")
    return [] if table is None else sorted(r[0] for r in table.distinct().collect())


def next_version(spark, path):
    """The number after the latest published version, counted from 0."""
    known = published(spark, path)
    return known[-1] + 1 if known else 0


def read_latest(spark, path, below=None):
    """The latest published version (below a number, if given), or None."""
    known = [n for n in published(spark, path) if below is None or n < below]
    return read_existing(spark, f"{path}/data/{known[-1]}") if known else None


def add_to_totals(delta, path, version, keys, sums, mins=()):
    """Add the counts of batch `version` to the running totals. A repeated batch replaces its
    own delta, and does nothing once a base holds it."""
    spark, columns = delta.sparkSession, [*keys, *sums, *mins]
    bases = published(spark, path)
    base = bases[-1] if bases else -1
    if version <= base:
        return
    delta.select(*columns).withColumn("version", F.lit(version).cast("long")).write.mode(
        "overwrite"
    ).parquet(f"{path}/deltas/{version}")
    if version - base >= COMPACT_EVERY:
        folded = read_totals(spark, path, keys, sums, mins)
        write_version(folded, path, version)
        for old in range(base + 1, version + 1):
            delete(spark, f"{path}/deltas/{old}")


def read_totals(spark, path, keys, sums, mins=()):
    """The running totals: the base and the deltas after it, summed; None before the first."""
    bases = published(spark, path)
    base = bases[-1] if bases else -1
    parts = read_existing(spark, f"{path}/deltas/*")
    rows = None if parts is None else parts.where(F.col("version") > base).drop("version")
    if bases:
        start = read_existing(spark, f"{path}/data/{base}").drop("version")
        rows = start if rows is None else start.unionByName(rows)
    if rows is None:
        return None
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in mins]
    )


def publish_snapshot(payload, path, version):
    """Keep the one-row payload as the latest."""
    write_version(payload, path, version)


def latest_snapshot(spark, path):
    """(msg, payload): the latest payload, or `no data` if there is none."""
    latest = read_latest(spark, path)
    if latest is None:
        return spark.range(1).select(
            F.lit("no data").alias("msg"), F.lit(None).cast("string").alias("payload")
        )
    return latest.select(F.lit("success").alias("msg"), "payload")


def snapshot_sections(snapshot, required=("req1", "req2", "req3", "req4"), optional=("req5", "req6", "req7", "req8")):
    """(section, content) rows; an optional section that is missing is an empty list."""
    content = lambda name: F.get_json_object("payload", f"$.{name}")
    rows = [F.struct(F.lit(n).alias("section"), content(n).alias("content")) for n in required]
    rows += [
        F.struct(F.lit(n).alias("section"), F.coalesce(content(n), F.lit("[]")).alias("content"))
        for n in optional
    ]
    return snapshot.where(F.col("payload").isNotNull()).select(F.inline(F.array(*rows)))


def show_result(title, df, rows=20):
    """Print a result table to the console."""
    print(f"----------- {title} -----------")
    df.show(rows, truncate=False)
