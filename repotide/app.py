"""The whole job: lines in, a snapshot of the eight results out, until stopped.

spark-submit repotide/app.py --out s3a://bucket/run --path s3a://bucket/lines
spark-submit repotide/app.py --out /data/run --source kafka \\
    --option kafka.bootstrap.servers=host:9092 --option subscribe=repos
"""

import argparse
import sys
import threading
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from repotide.contract import BATCH_INTERVAL, LANGUAGES  # noqa: E402
from repotide.scratch import read_existing  # noqa: E402
from repotide.session import build_session  # noqa: E402
from repotide.sources.ndjson import stream_lines  # noqa: E402
from repotide.streaming import landing, lifetime, recent, refresh  # noqa: E402


# How often a run that publishes seldom looks for unpublished work.
PAUSE_SECONDS = 600


def run(spark, lines, out, languages=LANGUAGES, interval=BATCH_INTERVAL, refresh_every=1):
    """Start the three jobs on a stream of lines; tables and checkpoints go below `out`.

    The landing job parses. The other two read its table, so each has its own checkpoint
    and can be restarted alone. With `interval=None` each job stops once it has caught up.
    Topics and similarity read all lifetime texts, so a large deployment publishes only
    every `refresh_every`-th micro-batch; `publish_pending`, the second value returned,
    publishes what has been folded since, and is called when a run ends or input pauses.
    """
    path = lambda name: f"{out}/{name}"
    jobs = [landing.land(lines, path("landed"), path("checkpoints/landed"), interval=interval)]
    if interval is None:
        jobs[0].awaitTermination()
    else:
        landing.wait_for_table(spark, path("landed"), jobs[0])

    good = landing.landed_stream(spark, path("landed")).where("not bad")
    jobs.append(
        recent.maintain_pushes(good, path("pushes"), path("checkpoints/pushes"), interval=interval)
    )
    if interval is None:
        jobs[1].awaitTermination()

    # A run before this one may have ended between folding a micro-batch and publishing it.
    pending, lock = set(), threading.Lock()
    if read_existing(spark, path("repos")) is not None:
        pending.add("restart")

    def publish_pending():
        with lock:
            if not pending:
                return
            pending.clear()
            refresh.refresh(
                spark, path("repos"), path("pushes"), path("totals"), path("snapshot"), languages
            )

    def fold(new, batch_id):
        with lock:
            refresh.fold_counts(new, path("totals"), batch_id, languages)
            pending.add(batch_id)
        if batch_id % refresh_every == 0:
            publish_pending()

    jobs.append(
        lifetime.maintain_repos(
            spark,
            path("landed"),
            path("index"),
            path("repos"),
            path("checkpoints/repos"),
            after=fold,
            interval=interval,
        )
    )
    if interval is None:
        jobs[2].awaitTermination()
        publish_pending()
    return jobs, publish_pending


def main():
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--out", required=True, help="folder of all tables and checkpoints")
    parser.add_argument("--source", default="text", help="streaming source with a value column")
    parser.add_argument("--path", help="folder of line files, for file sources")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--language", action="append", help="target language; repeatable")
    parser.add_argument("--interval", default=BATCH_INTERVAL)
    parser.add_argument("--refresh-every", type=int, default=1, metavar="BATCHES")
    parser.add_argument("--once", action="store_true", help="stop after what is available now")
    args = parser.parse_args()

    spark = build_session("repotide")
    options = dict(option.split("=", 1) for option in args.option)
    if args.path:
        options["path"] = args.path
    lines = stream_lines(spark, args.source, **options)
    interval = None if args.once else args.interval
    _, publish_pending = run(
        spark, lines, args.out, tuple(args.language or LANGUAGES), interval, args.refresh_every
    )
    while not args.once and not spark.streams.awaitAnyTermination(PAUSE_SECONDS):
        publish_pending()


if __name__ == "__main__":
    main()
