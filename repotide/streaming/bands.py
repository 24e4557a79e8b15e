"""Neighbouring pairs of an unbounded stream: a micro-batch pairs only its own new rows.

`similarity.band_candidates` numbers all texts of a language to pair each with the next few. In
arrival order only the last `band` texts of each language can still get a partner, so they are
all that is kept from one micro-batch to the next: at most `band` rows per language. A micro-batch
is paired together with that tail; pairs inside the tail are known already.

Rows of a micro-batch must have arrived after all earlier ones, as `seq` numbers given while
landing do. A repeated micro-batch starts from the same tail and replaces its own pairs.
"""

from pyspark.sql import functions as F

from repotide.contract import LANGUAGES, SIMILARITY_BAND
from repotide.operators.ranking import top_k
from repotide.operators.similarity import band_candidates
from repotide.operators.vocabulary import text_eligible
from repotide.scratch import read_existing, temporary, write_table
from repotide.sources import snapshots
from repotide.streaming.run import start

PAIRS = "language string, id1 long, id2 long"


def fold_pairs(new, path, version, languages=LANGUAGES, band=SIMILARITY_BAND):
    """Write the pairs that the texts of batch `version` complete, and the next tail."""
    spark = new.sparkSession
    with temporary(spark):
        rows = text_eligible(new, languages).select("language", "seq", "id")
        tail = snapshots.read_latest(spark, f"{path}/tail", below=version)
        if tail is not None:
            rows = rows.unionByName(tail.select("language", "seq", "id"))
        rows = write_table(rows, "band-rows")
        pairs = band_candidates(rows, band)
        if tail is not None:
            # At most `band` rows for each target language.
            known = tail.select(F.col("language"), F.col("id").alias("id2"))
            pairs = pairs.join(F.broadcast(known), ["language", "id2"], "left_anti")
        pairs.select("language", "id1", "id2").write.mode("overwrite").parquet(f"{path}/pairs/batch_id={version}")
        last = top_k(rows, ["language"], [F.desc("seq")], band).select("language", "seq", "id")
        snapshots.write_version(last, f"{path}/tail", version)


def maintain_pairs(stream, path, checkpoint, languages=LANGUAGES, band=SIMILARITY_BAND, interval=None):
    """Fold each micro-batch of new repositories."""

    def fold(rows, batch_id):
        fold_pairs(rows, path, batch_id, languages, band)

    return start(stream.writeStream.foreachBatch(fold), checkpoint, interval)


def pairs(spark, path):
    """(language, id1, id2): the pairs of all batches so far."""
    rows = read_existing(spark, f"{path}/pairs", f"{PAIRS}, batch_id long")
    return spark.createDataFrame([], PAIRS) if rows is None else rows.drop("batch_id")
