"""Connected components of an edge list, by alternating large-star and small-star steps.

Each step links the neighbours of a node to the smallest of them, so paths shrink to stars in a
logarithmic number of rounds and no node's neighbours are ever gathered in one row. A node with
very many edges meets a table with one row per node, in a join that Spark can split: that table has
a key of its own, so both sides start at their own exchange. Every round is written to the shared
folder, which cuts the lineage and survives lost executors; the round before it is removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.sources.scratch import discard, scratch_path


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """a, b and m, the smallest b of each a."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.bitwise_not("a").alias("flipped"), "m")
    return edges.join(least, F.bitwise_not(edges["a"]) == least["flipped"]).select("a", "b", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = _with_least(both).filter("b > a")
    return moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = _with_least(down)
    moved = found.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = down.groupBy("a").agg(F.min("b").alias("b"))
    return moved.union(own).distinct()


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges: (a long, b long) with a <> b. Returns (a, b): each node that is not the smallest
    of its component, and that smallest node."""

    def written(rows: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_path(spark, "stars")
        rows.select("a", "b").write.parquet(path)
        return path, spark.read.schema("a long, b long").parquet(path)

    path, stars = written(edges.filter("a <> b").distinct())
    state = _state(stars)
    while True:
        old, before = path, state
        path, stars = written(_small_star(_large_star(stars)))
        state = _state(stars)
        discard(spark, old)
        if state == before:
            return stars
