"""Connected components by alternating large and small stars, in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import tasks_for
from tidemark.session import cut_lineage


def _stars(edges: DataFrame, small: bool, tasks: int) -> DataFrame:
    """One step: hang neighbours on the least node around. ``edges`` has a > b.

    Small star: the smaller neighbours of each node. Large star: its larger neighbours.
    """
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    around = both.join(least, "a")
    if small:
        hung = around.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    else:
        hung = around.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").coalesce(tasks).distinct().coalesce(tasks)


def _settled(edges: DataFrame) -> bool:
    """Whether all edges form stars: each node hangs on one other, and on none that hangs itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("held")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hung"), F.lit(1).alias("held")))
    each = ends.groupBy("node").agg(F.sum("hung").alias("hung"), F.max("held").alias("held"))
    return each.where("hung > 1 or (hung = 1 and held = 1)").isEmpty()


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long): label is the least node reachable.

    ``known`` takes the labels of an earlier call, to which ``edges`` are added. Loops, repeated and
    null edges do no harm. A round joins and groups the edges; rounds grow with the logarithm of
    the longest chain. Nothing but a yes or no reaches the driver.
    """
    if known is not None:
        edges = edges.select("a", "b").unionByName(known.select(F.col("node").alias("a"), F.col("label").alias("b")))
    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # the stars never have more edges than these
    tasks = tasks_for(now)
    now = now.coalesce(tasks)
    while not _settled(now):
        now = cut_lineage(_stars(_stars(now, False, tasks), True, tasks))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
