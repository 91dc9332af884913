"""Connected components of a distributed edge table.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): each step hangs neighbours under the smallest node they
know of, and the number of rounds grows with the logarithm of the longest
chain's length. Rounds are written; only a row count and a checksum reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from florafold.operators.joins import exchanged
from florafold.session import written

MANY_EDGES = 100_000  # more of them are never broadcast, however small their files


def _with_least(edges: DataFrame, many: bool) -> DataFrame:
    """Edges (u, v) with m, the smallest v of their u.

    The edges of a node with many neighbours are dealt by a salt of the
    neighbour: the least of each (node, salt) first, then of each node, sent back to the salts that occur."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = edges.withColumn("_s", F.pmod(F.xxhash64("v"), F.lit(n)).cast("int"))
    least = salted.groupBy("u", "_s").agg(F.min("v").alias("m")).groupBy("u").agg(
        F.min("m").alias("m"), F.collect_list("_s").alias("_ss")).select("u", "m", F.explode("_ss").alias("_s"))
    return salted.join(exchanged(least) if many else least, ["u", "_s"]).drop("_s")


def _stars(edges: DataFrame, many: bool) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both, many).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("m"))
    large = large.select("u", F.col("m").alias("v")).where("u <> v").distinct()
    hung = _with_least(large, many)
    moved = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(hung.select("u", F.col("m").alias("v")).distinct()).where("u > v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge to another; component is its smallest node.

    Null ends and edges from a node to itself are ignored.
    """
    edges = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen, edges = state, written(_stars(edges, state[0] > MANY_EDGES), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
