"""Connected components of a link table, by alternating star operations.

Large-star links every larger neighbour of a node to the node's least
neighbour, small-star the lesser ones; both keep the components and end in
stars around the least node. Every round is two grouped minima and joins on
tables that are written to the shared folder; nothing but two numbers per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidings.session import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: a > b, once each."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("least"))
        moved = links.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b"))
        )).alias("link")).select("link.*")
    return moved.where("a > b").distinct()


def stars(links: DataFrame) -> DataFrame:
    """a, b for every node a that is not the least of its component; b is the least.

    `links` has columns a and b of one orderable, hashable type; direction,
    repeats and loops do not matter. No links: no rows.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, seen = written(links.distinct(), "links"), None
    while True:
        links = written(_star(_star(links, True), False), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return links
        seen = tuple(state)
