"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-k of any k is cut in each task before its shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Lifetime state ("once ever") outgrows the heap; RocksDB keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name="repotide", master=None, **settings):
    """A session with the job settings; on a cluster the submit command gives the master."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb_state(spark):
    """Switch new streaming queries of a caller's session to RocksDB state."""
    for key, value in SETTINGS.items():
        if "stateStore" in key:
            spark.conf.set(key, value)
