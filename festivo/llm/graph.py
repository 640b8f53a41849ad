"""Connected components of a link table as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step: every neighbour is linked with the smallest id of the neighbourhood.

    Large star looks at all neighbours and moves those above the node; small star looks at the
    neighbours below the node and moves them and the node.
    """
    if both_ways:
        sides = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = sides.groupBy("a").agg(F.min("b").alias("m"))
        linked = sides.join(lows, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        lows = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(lows, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = moved.unionAll(lows.select("a", F.col("m").alias("b")))
    return linked.where("a > b").distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``, the component being its smallest node.

    Alternating large-star and small-star steps (Kiveris et al. 2014), each round written to the scratch folder; ends when
    a round changes nothing. Links of a node with itself, repeated links and nulls are ignored; a table
    without links gives a table without rows. Hot nodes are pre-aggregated by the minimum, and their joins
    are left to adaptive skew splitting.
    """
    fingerprint = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    oriented = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = scratch.keep(oriented.distinct())
    before = current.agg(*fingerprint).first()
    while before[0]:
        following = scratch.keep(_star(_star(current, True), False))
        after = following.agg(*fingerprint).first()
        scratch.drop(current)
        current = following
        if after == before:
            break
        before = after
    tips = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return tips.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
