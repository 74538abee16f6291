"""Connected components of links, by alternating large and small stars.

Each round is a few aggregations and joins over the edges; its table is written
to the shared folder.  Minima are taken with partial aggregation and the joins
follow nothing that needs a key's rows together, so Spark may split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import stash


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b); the component is its smallest node."""
    edges = stash(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = _sign(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
        # Large star: the larger neighbours of a node meet its smallest one.
        large = both.filter("b > a").join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours meet the smallest of them.
        lower = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(lower, F.col("a") == F.col("u")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        edges = stash(small)
        now = _sign(edges)
        if now == sign:
            break
        sign = now
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own).distinct()
