"""Small helpers shared by the column expressions."""

from pyspark.sql import functions as F


def bind(value, body):
    """Evaluate `value` once per row and hand it to `body`.

    A column used inside a lambda is inlined by the optimizer, so an expression such as
    `lower(description)` would run once for each array element. A lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def small_table(spark, values, column, dtype="string"):
    """A one-column table of the given literals, made without a Python RDD."""
    literals = F.array(*[F.lit(v).cast(dtype) for v in values])
    return spark.range(1).select(F.explode(literals).alias(column))


def target_language(languages, column="language"):
    return F.col(column).isin(*languages)
