"""Landed search responses as a stream whose offsets are page numbers.

A producer lands response n as the folder `page=n` below a path that all executors reach, in any
order and by any number of writers. The stream hands out pages in the order of their numbers and
never past a page that is still missing, so its offset, the number of pages read, says all: after a
restart it goes on with the page after the last finished micro-batch, nothing is lost and nothing
is read twice. Each partition of a micro-batch is a range of pages that one task reads.

`register` makes it known to a session as the format `landed_pages`, with the options `path` and
`pages_per_partition`. Rows are (page, payload); `search.search_items` flattens them.
"""

import posixpath

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "landed_pages"
SCHEMA = "page long, payload string"
PAGES_PER_PARTITION = 64


def _files(path):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else (fs.LocalFileSystem(), path)


class PageRange(InputPartition):
    def __init__(self, first, stop):
        self.first, self.stop = first, stop


class PageReader(DataSourceStreamReader):
    def __init__(self, path, per_partition):
        self.path, self.per_partition = path, per_partition
        self.known = 0

    def initialOffset(self):
        return {"page": 0}

    def latestOffset(self):
        """One past the last page before the first missing one."""
        from pyarrow import fs

        system, root = _files(self.path)
        if system.get_file_info(root).type == fs.FileType.NotFound:
            return {"page": self.known}
        names = {posixpath.basename(f.path) for f in system.get_file_info(fs.FileSelector(root))}
        while f"page={self.known}" in names:
            self.known += 1
        return {"page": self.known}

    def partitions(self, start, end):
        first, stop, step = start["page"], end["page"], self.per_partition
        return [PageRange(n, min(n + step, stop)) for n in range(first, stop, step)]

    def read(self, partition):
        from pyarrow import fs

        system, root = _files(self.path)
        for page in range(partition.first, partition.stop):
            for file in sorted(system.get_file_info(fs.FileSelector(f"{root}/page={page}")), key=lambda f: f.path):
                if posixpath.basename(file.path).startswith(("_", ".")):
                    continue
                with system.open_input_stream(file.path) as stream:
                    for line in stream.read().decode().splitlines():
                        yield page, line

    def commit(self, end):
        pass


class LandedPages(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        per_partition = int(self.options.get("pages_per_partition", PAGES_PER_PARTITION))
        return PageReader(self.options["path"], per_partition)


def register(spark):
    """Workers get the source by value, so they need no copy of this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedPages)


def stream_pages(spark, path, pages_per_partition=PAGES_PER_PARTITION):
    register(spark)
    options = {"path": path, "pages_per_partition": str(pages_per_partition)}
    return spark.readStream.format(FORMAT).options(**options).load()


def land_pages(pages, path):
    """Write rows (page, payload), one per page, as a producer would leave them."""
    rows = pages.select("page", F.col("payload").alias("value"))
    rows.repartition("page").write.mode("append").partitionBy("page").text(path)
