"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import checked, drop_staged, stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """links (u, v) -> (node, root) for every node in a link but the roots: root is the least node that links reach.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller ones, to the
    least node it knows. Each step is a grouped minimum, which combines before the shuffle, and a join with it: by broadcast
    up to a checked size, beyond it between two plain shuffles, which Spark can split for a node with many neighbours."""
    links = stage(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        minima = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        least = checked(minima)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = stage(large.unionByName(both.filter("v < u").join(least, "u").filter("m = u").select("u", "v")).distinct(), "low")
        small_least = stage(low.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = low.join(checked(small_least), "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x")).select(F.col("x.u").alias("u"), F.col("x.m").alias("v"))
        following = stage(small.filter("u <> v").distinct(), "links")
        now = _state(following)
        for done in (links, minima, low, small_least):
            drop_staged(done)
        links = following
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
