"""The test tables in the shape of the record contract."""

from pyspark.sql import functions as F

TEXT_LANGUAGES = ("en", "fr", "de", "es")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_LANGUAGES = ("click", "purchase", "signup")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir):
    """Texts. Arrival order is the id order; there is no push or creation time."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        F.col("lang").alias("language"),
        F.col("text").alias("description"),
        F.col("n_chars").alias("stargazers_count"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def _event_columns(events):
    """A user is a repository that is pushed many times."""
    return events.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("language"),
        F.floor("value").alias("stargazers_count"),
        F.col("ts").cast("timestamp").alias("pushed_at"),
    )


def events(spark, sf_dir):
    return _event_columns(table(spark, sf_dir, "events"))


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # A stream must be given a folder or a pattern; the braces make a pattern that only the table's
    # name matches, whether it is one file or a folder of files.
    return _event_columns(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}"))


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("language"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("stargazers_count"),
        F.col("o_orderdate").alias("created_at"),
    )


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("seq"),
        F.col("p_brand").alias("language"),
        F.col("p_name").alias("description"),
    )
