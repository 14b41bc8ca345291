"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import Work, few


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, work: Work) -> DataFrame:
    """Map every linked node to the smallest node of its component: columns `u`, `v`.

    `links` has columns `a`, `b`, in any order and with repetitions. Large-star and small-star
    steps alternate until nothing changes; the number of rounds grows with the logarithm of the
    component's size. The smallest node itself has no row. Links to oneself are ignored.

    Steps run in as many tasks as their rows need. Smallest neighbours are stored first: a join with
    them has plain exchanges on both sides, so that adaptive execution can split the rows of a node
    with very many links.
    """
    rows = 2 * links.count()

    def least(edges: DataFrame) -> DataFrame:
        return work.stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least", rows)

    edges = work.stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v").distinct(), "links", rows)
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = few(both.join(least(both), "u"), rows).where("v > u") \
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = work.stored(large, "large", rows)
        smallest = least(large)
        small = (few(large.join(smallest, "u"), rows).where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        edges = work.stored(small, "small", rows)
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges
