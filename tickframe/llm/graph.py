"""Connected components by alternating large and small stars.

Every step is a grouped minimum with map-side combine and a join back, so no
component is gathered; edges live in tables of the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected edges ``u, v``; the root
    is the smallest node reachable. No edges give no rows; null ends are not
    edges; loops and repeated edges do no harm."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = scratch_table(e.filter("u <> v").distinct(), "edges")
    mark = _mark(e)
    while True:
        # large star: a node's larger neighbours move to its smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = scratch_table(small, "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
