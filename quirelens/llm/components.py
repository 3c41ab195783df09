"""Connected components of a distributed edge list (alternating large-star and small-star).

A node that very many edges have is looked up without a shuffle, so that the centre of a large star is no task's own.
Null ends: such edges are left out.  Repeated edges and edges of a node with itself change nothing.  No edges: no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, hot_lookup, materialize, release

#: With fewer edges than this no node has enough of them to matter.
MANY = 100_000


def _star(edges: DataFrame, larger: bool, n: int) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # min per node by an aggregate that combines before the shuffle; then each edge looks it up
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("k")).withColumn("m", F.least("a", "m"))
    linked = both.join(least, "a") if n < MANY else hot_lookup(both, least, ["a"], "k")
    if larger:
        out = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (longs).  Returns node, root for every node with an edge; root is the least node of
    its component.  Rounds grow with the logarithm of the longest path; each is a written table."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    last, n = None, now.count()
    while True:
        before, now = now, materialize(_star(_star(now, True, n), False, n), "stars")
        forget(before)
        release(now.sparkSession)
        # it ends when all edges are stars whose centres are no one's leaf
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last, n = state, state[0]
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
