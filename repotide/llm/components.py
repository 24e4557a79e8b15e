"""Connected components of an edge table by alternating large-star and small-star steps.

Each step keeps one edge per vertex and neighbour at most and is reduced before it is shuffled;
steps are written to the shared folder, so no lineage grows and a lost executor costs one step.
"""

from pyspark.sql import functions as F

from repotide.scratch import write_table


def _rewired(edges):
    """(v, m): each neighbour v of u with u's smallest neighbour m."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges):
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _rewired(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges):
    """Edges stand as (larger u, smaller v)."""
    joined = _rewired(edges)
    down = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return down.unionAll(own).where("u <> v").distinct()


def _state(edges):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF)))).first()


def components(edges):
    """(vertex, root) of every vertex of edges (u, v) that is not its component's smallest."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = write_table(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = write_table(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
