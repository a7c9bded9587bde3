"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsight.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node of its component) for every node of ``links`` (``a``, ``b``, long).

    Each round hangs every node's larger neighbours on its smallest one, then
    its smaller neighbours likewise; the edges end as stars around the smallest
    nodes, after rounds that the published analysis of this method bounds by the
    square of the logarithm of the nodes. Minima are combined on the map side
    and the joins are plain equality joins, which adaptive execution splits
    where one node has most edges.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = saved(small.select("e.u", "e.v").where("u > v").distinct(), "edges")
        # Done when every larger end has one edge and no smaller end is a larger one: stars.
        down = new.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(new.select(F.col("v").alias("node"), F.lit(0).alias("up")).distinct())
        bad = down.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n")).where("ups > 0 and n > 1").limit(1).count()
        edges = new
        if not bad:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
