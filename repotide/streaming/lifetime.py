"""Once-ever state: which repositories have been seen, and running totals over them.

State is a streaming aggregation by id. Rows of one id are reduced in each task before the
shuffle, so a hot id costs one row per task, and the winner is the same on every run: the
earliest batch, then the lowest `seq` in it. State keeps only the carried columns.
"""

from pyspark.sql import functions as F

from repotide.contract import REPO_SCHEMA
from repotide.operators import counts
from repotide.operators.state import first_seen
from repotide.sources import snapshots
from repotide.streaming.landing import landed, landed_stream, stamp_batch
from repotide.streaming.run import start, with_rocksdb


LANGUAGE_TOTALS = (["language"], ["repos", "stars", "rated"])
TOTALS = "language string, repos long, stars long, rated long"


def first_seen_updates(stream, carry, arrival=("batch_time", "seq")):
    """Per id touched by a micro-batch: its first version, and whether that is new."""
    arrival = F.struct(*arrival)
    return (
        stamp_batch(with_rocksdb(stream))
        .groupBy("id")
        .agg(
            F.min_by("seq", arrival).alias("seq"),
            *[F.min_by(c, arrival).alias(c) for c in carry],
            (F.min("batch_time") == F.max("batch_time")).alias("new"),
        )
    )


def newly_seen(updates):
    return updates.where("new").drop("new")


def fold_language_totals(new, path, version):
    snapshots.add_to_totals(counts.language_totals(new), path, version, *LANGUAGE_TOTALS)


def maintain_totals(stream, path, checkpoint, interval=None):
    """Running (language, repos, stars, rated) totals of unique repositories.

    Each micro-batch adds its new repositories to the totals of the one before; nothing is
    recomputed from the lifetime data.
    """

    def fold(updates, batch_id):
        fold_language_totals(newly_seen(updates), path, batch_id)

    updates = first_seen_updates(stream, ["language", "stargazers_count"])
    return start(updates.writeStream.outputMode("update").foreachBatch(fold), checkpoint, interval)


def language_totals(spark, path):
    """The totals so far; no rows before the first repository."""
    totals = snapshots.read_totals(spark, path, *LANGUAGE_TOTALS)
    return spark.createDataFrame([], TOTALS) if totals is None else totals


def lifetime_counts(spark, path):
    return counts.counts_of_totals(language_totals(spark, path))


def lifetime_averages(spark, path):
    return counts.averages_of_totals(language_totals(spark, path))


def maintain_repos(
    spark, table, index, repos, checkpoint, schema=REPO_SCHEMA, after=None, interval=None
):
    """Append each repository's first version, with all columns, to the `repos` table.

    State holds only where the first version was landed. Its row is then fetched from just
    the landed partitions a micro-batch refers to. Both writes replace the partition of
    their micro-batch, so a repeated batch changes nothing. `after(new_repos, batch_id)` runs last.
    """

    def append(updates, batch_id):
        part = f"batch_id={batch_id}"
        newly_seen(updates).write.mode("overwrite").parquet(f"{index}/{part}")
        new = spark.read.parquet(f"{index}/{part}")
        # Spark reads only the landed partitions of the batches in `new` (dynamic pruning).
        source = landed(spark, table, schema).where(~F.col("bad"))
        source = source.join(new.select("batch").distinct(), "batch", "left_semi")
        rows = source.join(new, ["batch", "id", "seq"], "left_semi")
        first_seen(rows.drop("line", "bad", "batch"), ["id"]).write.mode("overwrite").parquet(
            f"{repos}/{part}"
        )
        if after:
            after(spark.read.parquet(f"{repos}/{part}"), batch_id)

    good = landed_stream(spark, table, schema).where(~F.col("bad")).drop("batch_time")
    updates = first_seen_updates(good, ["batch"], arrival=("batch", "seq"))
    return start(updates.writeStream.outputMode("update").foreachBatch(append), checkpoint, interval)


# Counts straight from the state of a query, without a table of totals.

STATE_FIELDS = ("language", "stargazers_count")


def maintain_state(stream, checkpoint, interval=None):
    """Keep the first version of each id in the state of a query that writes nothing.

    The checkpoint is the result: `lifetime_state` reads it, also after the query has ended and
    whether or not it is started again. One struct for each id holds what is carried.
    """
    version = F.struct("batch_time", "seq", *STATE_FIELDS)
    firsts = stamp_batch(with_rocksdb(stream)).groupBy("id").agg(F.min(version).alias("first"))
    return start(firsts.writeStream.outputMode("update").format("noop"), checkpoint, interval)


def lifetime_state(spark, checkpoint):
    """(id, seq, language, stargazers_count): the state as of the last finished micro-batch.

    Each state partition is read by a task of its own from the checkpoint folder.
    """
    state = spark.read.format("statestore").load(checkpoint)
    first = F.col("value")["min"]
    return state.select(F.col("key")["id"].alias("id"), first["seq"].alias("seq"), *[first[c].alias(c) for c in STATE_FIELDS])


def state_totals(spark, checkpoint):
    """(language, repos, stars, rated) from the state."""
    return counts.language_totals(lifetime_state(spark, checkpoint))
