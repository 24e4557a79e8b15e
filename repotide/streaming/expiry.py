"""First versions with a bound: a repository is new again once nothing of it came for some time.

`lifetime` keeps every id for ever. A producer that repeats a repository only within some time
needs no more than that. Versions of an id that follow each other within `bound` are one
session, and its first version counts. A session leaves the state when the watermark has passed
its last version by `bound`, so state holds the ids of the last `bound` plus `late` and no others.
If all versions of an id lie in one session, as the producer promises, this is `dedup_first_seen`.

Both forms are one aggregation by session. Versions of an id are merged in each task before they
are shuffled, so a hot id moves one row per task and session. The stream emits a session's first
version once, when the session has closed, and never changes it.
"""

from pyspark.sql import functions as F

from repotide.streaming.run import with_rocksdb

# Sessions are merged in each task before the shuffle.
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def first_of_sessions(repos, bound):
    """The first version, by (push time, seq), of each session of each id; other columns as in it.

    For a finished table or, with a watermark on `pushed_at`, a stream.
    """
    repos.sparkSession.conf.set(LOCAL_MERGE, "true")
    version = F.struct("pushed_at", "seq")
    rest = [c for c in repos.columns if c not in ("id", "pushed_at", "seq")]
    firsts = repos.groupBy(F.session_window("pushed_at", bound), "id").agg(
        F.min(version).alias("first"), *[F.min_by(c, version).alias(c) for c in rest]
    )
    return firsts.select("id", "first.seq", "first.pushed_at", *rest)


def first_seen_within(stream, bound, late):
    """A stream of the first versions of closed sessions. Rows more than `late` behind the newest
    push are dropped."""
    return first_of_sessions(with_rocksdb(stream).withWatermark("pushed_at", late), bound)


def ids_within(stream, bound):
    """A stream of ids, each at its first row and not again for at least `bound` of push time.

    At once, not when a session has closed; so of the versions in one micro-batch it cannot say
    which came first, and gives the id alone.
    """
    marked = with_rocksdb(stream).select("id", "pushed_at").withWatermark("pushed_at", bound)
    return marked.dropDuplicatesWithinWatermark(["id"]).select("id")
