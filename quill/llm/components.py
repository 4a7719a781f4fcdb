"""Connected components of an edge table, by alternating stars.

Each round points every node's larger neighbours at its smallest neighbour (large
star) and then every node and its smaller neighbours at the smallest of them
(small star). Rounds grow with the logarithm of the nodes; a hub's rows are joined
with one row per node, which Spark's adaptive skew join may split. The edges of
each round are a written table, so a lost executor costs one round at most; the table
before it goes. No node or edge reaches the driver, only a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import discard, shuffles_go, skew_join, stored

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    with shuffles_go(edges.sparkSession):
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another node; component is
    the smallest node reachable. Null ends, loops and repeated edges don't matter."""
    e = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    was = _mark(e)
    for _ in range(MAX_ROUNDS):
        if not was[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = skew_join(both.where(F.col("v") > F.col("u")), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (skew_join(large, low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, e = e, stored(small, "edges")
        discard(before)
        now = _mark(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    # every remaining edge points at its component's smallest node
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out.stored_at = e.stored_at     # for discard
    return out
