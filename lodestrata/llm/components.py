"""Connected components of a graph of longs, by alternating large-star and small-star steps.

Each round links every node to the smallest node that it sees; rounds go on until no edge
changes, O(log n) or so of them. Edges are always tables: nothing but their number and a
checksum goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.storage import Workspace


def _star(work: Workspace, pairs: DataFrame, name: str) -> DataFrame:
    """``pairs`` (u, v) with the smallest v of each u, as (u, v, m). A hub's rows are never gathered."""
    least = work.table(pairs.groupBy("u").agg(F.min("v").alias("m")), name)
    return pairs.join(least, "u")


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b)."""
    found = work.table(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while found.limit(1).count():
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(work, both, "large").withColumn("m", F.least("m", "u")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        wide = work.table(large.distinct(), "large-edges")
        small = _star(work, wide, "small")
        ends = small.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        narrow = work.table(ends.where(F.col("u") != F.col("v")).distinct(), "small-edges")
        work.drop(found)
        work.drop(wide)
        found = narrow
        now = narrow.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
