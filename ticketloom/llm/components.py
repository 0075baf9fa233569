"""Connected components by alternating large and small stars, in joins and aggregates.

Neighbour lists are never gathered: each step only needs the smallest neighbour
of a node, so a hub with a third of all edges is a partial minimum and a join
whose other side holds one row for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import unstaged
from ticketloom.session import stage


def _large(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(others)


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of numbers to ``node`` and ``label``, the smallest number it
    reaches, for every node of an edge between different nodes (labels included)."""
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state, before = mark, now
        now = stage(_small(_large(now)).distinct(), "stars")
        unstaged(before)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = stage(stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct()), "labels")
    unstaged(now)
    return labels
