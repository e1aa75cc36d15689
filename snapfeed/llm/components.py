"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfeed.llm.common import drop_stored, stored


def connected_components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``links``: (u, v), in any direction, with repeats. Returns (node,
    component): for every node of a link the smallest node it reaches.

    Alternating large-star and small-star steps: each step hangs a node's
    neighbours on the smallest one, found by a partially aggregated minimum, so
    a node with a third of all links is reduced before the shuffle. Every round
    is written to the shared folder. An empty table has no components."""
    links = links.where("u is not null and v is not null and u <> v")
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        before, now = now, after
        new = _state(now)
        drop_stored(now.sparkSession, before)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
