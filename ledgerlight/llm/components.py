"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import checkpointed

MAX_ROUNDS = 60


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (a, b) that isn't its component's smallest node, the root.

    Hubs are handled by aggregates with partial sums and by joins that adaptive execution splits; nothing is collected.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = checkpointed(now)
    for _ in range(MAX_ROUNDS):
        if _is_star_forest(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # every larger neighbour is linked to the smallest of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        now = checkpointed(small.select("e.*").where("a <> b").distinct())
    raise RuntimeError("components did not settle")
