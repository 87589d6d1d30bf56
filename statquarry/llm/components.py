"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.storage import saved
from statquarry.session import splittable_join


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least node around it."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return splittable_join(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = splittable_join(down, least, ["a"]).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """(a, b) for every node ``a`` that is linked and not the least of its component; ``b`` is that least node.

    ``links`` has two long columns.  Each round is written to shared storage.  Minima are combined before the shuffle and
    the joins can be split, so a node linked to a third of all others is no different.  The number of rounds grows with
    the logarithm of the component sizes.
    """
    links = saved(links.toDF("a", "b").where("a <> b").distinct(), "links")
    state = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state or mark[0] == 0:
            return links
        state = mark
        links = saved(_small_star(_large_star(links).distinct()).distinct(), "links")
