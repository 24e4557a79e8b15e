"""Intermediate tables in the shared folder the cluster names in spark.checkpoint.dir.

A written table cuts lineage and survives the loss of executors. In-process local mode without
the setting (tests, a laptop) gets a temporary folder; anything with executors of its own needs
the setting, because a machine-local folder would not be visible to them. Tables are kept in a
folder per application; `temporary` deletes those of a block of work when it ends.

A block owns the tables that its own thread makes, and those of threads it starts through
`inherited`. Jobs that run side by side in other threads are not touched by its end.
"""

import contextlib
import contextvars
import functools
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException

SETTING = "spark.checkpoint.dir"
# The lists of paths of the blocks that the current thread is in, outermost first.
_scopes = contextvars.ContextVar("scratch scopes", default=())


def scratch_path(spark, label):
    base = spark.conf.get(SETTING, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {SETTING} to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="repotide-")
        spark.conf.set(SETTING, base)
    application = spark.sparkContext.applicationId
    path = f"{base.rstrip('/')}/{application}/{label}-{uuid.uuid4().hex}"
    for paths in _scopes.get():
        paths.append(path)
    return path


def inherited(function):
    """`function` for another thread: what it writes belongs to the blocks open here and now."""
    scopes = _scopes.get()

    @functools.wraps(function)
    def run(*args, **options):
        token = _scopes.set(scopes)
        try:
            return function(*args, **options)
        finally:
            _scopes.reset(token)

    return run


def write_table(df, label):
    """Write `df` as Parquet below the shared folder and return the table read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark, path):
    """Delete a folder of tables on whatever file system it is; nothing happens if it is gone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def temporary(spark):
    """Scratch tables made inside the block are deleted after it; read nothing of them later."""
    paths = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            delete(spark, path)


def read_existing(spark, path, schema=None):
    """The Parquet table at `path`, or None if nothing has been written there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
