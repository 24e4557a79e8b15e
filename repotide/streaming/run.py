"""Starting a query the way all jobs do."""

from repotide.session import use_rocksdb_state


def start(writer, checkpoint, interval=None):
    """Run at `interval`, or over everything available now and then stop."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def finish(query):
    query.awaitTermination()
    return query


def with_rocksdb(stream):
    use_rocksdb_state(stream.sparkSession)
    return stream
