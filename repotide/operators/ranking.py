"""Top-k per group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

# Parts of a group that are ranked on their own first.
SALTS = 64


def top_k(df, group, order, k, rank="rank"):
    """The first k rows of each group as `rank` 1..k. `order` must be a total order.

    Rows are first ranked within SALTS parts of each group, on as many tasks. Before that
    shuffle Spark keeps k rows per part and task (WindowGroupLimit; the session raises its
    threshold for k). The task that ranks a whole group then gets at most SALTS * k rows,
    however large the group and however many tasks there were.
    """
    group, order = list(group), list(order)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    df = _ranked(df.withColumn("_salt", salt), [*group, "_salt"], order, k, "_rank")
    return _ranked(df.drop("_salt", "_rank"), group, order, k, rank)


def _ranked(df, group, order, k, rank):
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, number).where(F.col(rank) <= k)
