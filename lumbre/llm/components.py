"""Connected components of a graph given as a table of edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre.sources.tables import save_scratch, scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); a component is named by its lowest node.

    Every round each node hands its higher neighbours, then its lower ones, to the lowest neighbour, until the
    edges form stars. A round is written to the shared folder, which cuts the lineage, and the one before it goes; the number of rounds grows
    with the logarithm of the longest chain, and no edge list comes together in one task or on the driver.
    """
    ends = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    with scratch(edges.sparkSession) as scope:
        now = save_scratch(edges.where("u <> v").select(*ends).distinct(), "edges")
        before, mark = None, _mark(now)
        while mark != before:
            both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
            large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            lowest = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").select(*ends).distinct()
            done, now = now, save_scratch(small, "edges")
            scope.drop(done)
            before, mark = mark, _mark(now)
        stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        return scope.keep(stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
