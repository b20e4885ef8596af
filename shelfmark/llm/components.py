"""Connected components of an edge table by alternating large-star and small-star steps.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)  Each step is a
group-by-minimum with map-side combine, written to the shared folder, and a join of the edges with
that table.  (Unwritten, the aggregate would share the join's exchange, which AQE does not split.)  So
a node with very many neighbours never meets in one task.  Only two numbers per step reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(materialize(low, "low"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): component is the smallest node reachable.  Only nodes with an edge appear.

    Null ends and self-edges are ignored; repeated edges count once.
    """
    now = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct()
    now = materialize(now, "edges")
    seen = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["h"])
        now = materialize(_small_star(materialize(_large_star(now), "large_star")), "small_star")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
