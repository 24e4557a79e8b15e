"""A table that grows by a small folder per batch and stays a small number of folders.

A manifest lists the folders that make up the table, each with its tier and the batches it holds.
A batch adds a folder of tier 0. As soon as FAN folders of a tier are there, they are written as
one of the next tier, so b batches are at most FAN - 1 folders of each of log_FAN(b) tiers, and a
row is rewritten once per tier. A manifest is published as a version behind a pointer
(`snapshots.write_version`): readers follow one manifest, which never names a folder that is being
written, and a writer that dies leaves the manifest before in place. A folder that is no longer
listed stays until no kept manifest names it, so readers of the one before are not disturbed.

Batches come in rising order from one writer. Adding a batch again is without effect.
"""

from repotide.scratch import delete
from repotide.sources import snapshots

FAN = 8
FOLDERS = "folder string, tier int, first long, last long"


def _manifest(spark, path, version=None):
    """[(folder, tier, first, last)] of a version, the latest if none is given."""
    known = snapshots.published(spark, path)
    if not known:
        return []
    rows = spark.read.parquet(f"{path}/data/{known[-1] if version is None else version}")
    return [(r.folder, r.tier, r["first"], r["last"]) for r in rows.orderBy("first").collect()]


def folders(spark, path):
    """The folders that make up the table now: their number is logarithmic in that of batches."""
    return _manifest(spark, path)


def _merge(spark, path, schema, listed, tier):
    """Write the folders of one tier as one of the next, if there are FAN of them. The rebalance
    makes files of the session's advisory partition size, however large the batches were."""
    full = [x for x in listed if x[1] == tier]
    if len(full) < FAN:
        return listed, False
    first, last = full[0][2], full[-1][3]
    name = f"tiers/{tier + 1}-{first}-{last}"
    rows = spark.read.schema(schema).parquet(*[f"{path}/{x[0]}" for x in full])
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{name}")
    rest = [x for x in listed if x[1] != tier]
    return sorted([*rest, (name, tier + 1, first, last)], key=lambda x: x[2]), True


def append(df, path, batch):
    """Add the rows of `df` as `batch`; merge what has become full; publish the new list."""
    spark = df.sparkSession
    listed = _manifest(spark, path)
    if listed and listed[-1][3] >= batch:
        return
    name = f"tiers/0-{batch}-{batch}"
    df.write.mode("overwrite").parquet(f"{path}/{name}")
    listed, tier, merged = [*listed, (name, 0, batch, batch)], 0, True
    while merged:
        listed, merged = _merge(spark, path, df.schema, listed, tier)
        tier += 1
    snapshots.write_version(spark.createDataFrame(listed, FOLDERS), path, batch)
    _clean(spark, path)


def _clean(spark, path):
    """Delete the folders that no kept manifest names, also those of a writer that died."""
    named = {x[0] for v in snapshots.published(spark, path) for x in _manifest(spark, path, v)}
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/tiers")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(root):
        name = f"tiers/{status.getPath().getName()}"
        if name not in named:
            delete(spark, f"{path}/{name}")


def read(spark, path, schema):
    """The table as its latest manifest lists it."""
    listed = folders(spark, path)
    if not listed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{x[0]}" for x in listed])


def between(spark, path, schema, first, last):
    """Rows of the folders that may hold batches `first` to `last`; other folders are not read."""
    listed = [x for x in folders(spark, path) if x[2] <= last and x[3] >= first]
    if not listed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{x[0]}" for x in listed])
