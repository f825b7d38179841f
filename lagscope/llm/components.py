"""Connected components of links between ids, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut


class Forest:
    """Union-find over the numbers 0 to n - 1; the smallest number is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """False if both were joined before."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, root) for every id in ``links`` (a, b): the smallest id it is connected to.

    Rounds of large star and small star: every node is linked to the smallest of
    its neighbours, first on the side of the larger ids, then on the side of the
    smaller ones. The number of links never grows, and a chain of n links takes
    about log n rounds. A hub with a third of all links is one group, but only its
    minimum is taken, before the shuffle; its links stay single rows. Nulls and
    links from an id to itself are left out.
    """
    edges = cut(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low)
            .filter("a <> b")
            .distinct()
        )
        edges = cut(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # Every node is now linked to its root alone, and roots have no link upwards.
    rooted = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return rooted.union(rooted.select(F.col("root").alias("id"), "root").distinct())
