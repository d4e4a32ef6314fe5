"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.session import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every id in links (a, b) with a != b.

    Alternates two rounds until only stars are left: every id links its larger neighbours to the
    smallest neighbour or itself (large star), then its smaller neighbours likewise (small star).
    The number of links never grows, and the rounds grow with the logarithm of the longest
    chain. Minima are aggregated before the shuffle, and an id with a third of the links is
    handled by a join on it that Spark may split, not by gathering its neighbours. Repeated
    links and links in both directions count once; no links give no rows.
    """
    edges = stored(_directed(links), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.groupBy(F.col("a").alias("i")).agg(F.min("b").alias("lo"), F.max("b").alias("hi"))
        ends = stored(ends, "neighbours")
        # In a star all but the smallest have one neighbour.
        if ends.filter("lo < i and hi > lo").isEmpty():
            return ends.select(F.col("i").alias("id"), F.least("i", "lo").alias("component"))
        least = ends.select("i", F.least("i", "lo").alias("m"))
        moved = both.filter("b > a").join(least, F.col("a") == F.col("i"))
        large = stored(moved.select(F.col("m").alias("a"), "b"), "large-star")
        # Links now point from the larger (b) to smaller ids (a).
        lows = stored(large.groupBy(F.col("b").alias("i")).agg(F.min("a").alias("m")), "lows")
        turned = large.join(lows, F.col("b") == F.col("i")).filter("a > m").select(F.col("m").alias("x"), "a")
        edges = stored(
            lows.select(F.col("m").alias("a"), F.col("i").alias("b")).unionByName(turned.toDF("a", "b")), "small-star"
        )


def _directed(links: DataFrame) -> DataFrame:
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.filter("a < b")
