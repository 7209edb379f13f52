"""Connected components of an undirected graph given as pairs, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homespan.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each round links every node to the smallest node around it, once over larger and once over
    smaller neighbours, and is written to the checkpoint folder. A hot centre costs one partial
    minimum and a join whose large partitions can be split. Loops and repeated pairs are
    ignored; an empty input gives an empty result.
    """
    now = stored(_ordered(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    seen = None
    while (mark := _mark(now)) != seen:
        seen = mark
        now = stored(_small_star(_large_star(now)))
    star = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return star.unionByName(roots).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    """u > v, each pair once."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    larger = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return _ordered(larger.join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select("v", F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(moved.unionByName(least.select("u", F.col("m").alias("v"))))
