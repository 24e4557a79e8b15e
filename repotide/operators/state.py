"""Dedup and batching: which version of a repository counts, and when."""

from pyspark.sql import functions as F

from repotide.contract import BATCH_INTERVAL


def first_seen(df, keys, order="seq"):
    """The first row of each key in arrival order.

    One `min_by` per column rather than one over a struct: the optimizer then drops the
    columns a caller does not use before the shuffle. Partial aggregation reduces a hot key
    to one row per task before anything moves.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(
        F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in rest]
    )


def dedup_first_seen(repos, order="seq"):
    """Once ever: the first version of each repository wins."""
    return first_seen(repos, ["id"], order)


def dedup_within_batch(repos, batch="batch_time", order="seq"):
    """Once per batch: the first version in the batch wins."""
    return first_seen(repos, [batch, "id"], order)


def assign_batch(repos, interval=BATCH_INTERVAL, time="pushed_at"):
    """Replay batches: each row gets the end of its tumbling interval as `batch_time`."""
    return repos.withColumn("batch_time", F.window(time, interval)["end"])
