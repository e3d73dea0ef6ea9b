"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.sources.shared import materialize


def _toward_min(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of `edges` (a, b): comp is the least node of its component.

    Each round is two joins on the node, written to the shared folder; rounds end when the edges stand still.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_min(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _toward_min(large.filter("u <> v"))
        tied = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = materialize(tied.filter("u <> v").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()
        mark = seen
