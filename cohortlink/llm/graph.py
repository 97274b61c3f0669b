"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlink.llm.common import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link and the smallest node it reaches.

    Each round links all larger neighbours of a node to its smallest neighbour
    (large star) and then all smaller ones (small star); the rounds needed grow
    with the logarithm of the longest chain.  Minima are partial aggregates
    and the join sides are a link table and one row per node, so a node with
    very many links is split by the adaptive skew join.  Self links and null
    ends are ignored; no links: no rows.
    """
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    e, mark = materialise(e, "links"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            return _labels(e)
        mark = tuple(now)
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        e = materialise(small.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "links")


def _labels(e: DataFrame) -> DataFrame:
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
