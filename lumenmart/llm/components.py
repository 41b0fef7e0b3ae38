"""Connected components of a graph that stays distributed.

Alternating large-star and small-star rounds (Kiveris et al., 2014): each round
hooks every node to the smallest node that it or its neighbours know, until
all edges lead to the smallest node of their component. A round has two
aggregations and two joins; edges of a hub are split by adaptive skew joins,
and its minimum is pre-aggregated. Every round is written to the shared
folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node with a link to another.

    Links are undirected; repeated links, links of a node with itself and links
    with a null end are ignored. No links give no rows.
    """
    first, second = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    edges = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"), first.isNotNull().alias("x"), second.isNotNull().alias("y"))
    edges = saved(edges.filter("x and y and a > b").select("a", "b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = saved(_small_star(_large_star(edges)), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
