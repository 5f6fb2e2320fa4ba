"""Connected components by alternating large-star and small-star steps on an edge table.

Every half step is written before the next reads it, so no plan holds more than one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """Per vertex u: its smallest neighbour and its number of edges, by which hot vertices are joined apart."""
    return edges.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("size_"))


def _large(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour above a vertex is hung on the smallest of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(_lowest(both).withColumn("low", F.least("low", "u")), "lowest")
    return join_groups(both.where("v > u"), low, "u", "size_", total).select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame, total: int) -> DataFrame:
    """A vertex and its smaller neighbours are hung on the smallest of them."""
    low = materialize(_lowest(edges), "lowest")
    moved = join_groups(edges, low, "u", "size_", total).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every vertex is the centre of one star or a leaf of one: then each component is a star."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    per = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return per.where((F.col("leaf") > 1) | ((F.col("leaf") == 1) & (F.col("centre") == 1))).isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(vertex, root) for every vertex of edges (a, b), root being the smallest vertex reached."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        if _stars(now):
            tops = now.select("v").distinct()
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(tops.select(F.col("v").alias("vertex"), F.col("v").alias("root")))
        hung = materialize(_large(now, now.count()), "large-star")
        now = materialize(_small(hung, hung.count()), "small-star")
    raise RuntimeError("components did not settle")
