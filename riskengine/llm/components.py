"""Connected components of an edge table, wholly on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskengine.llm.store import materialise


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(a, b) links -> (node, component), the component being the smallest node reachable.

    Alternating star contraction: every neighbour of a node is hung on the smallest node near it, first
    the larger neighbours, then the smaller ones. The number of rounds grows with the logarithm of a
    component's size. Each round's edges are written to the shared folder, so nothing is recomputed
    when an executor is lost. A node with very many neighbours costs no single task: minima are combined
    before the shuffle and the joins are left to the adaptive skew join.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialise(now, "edges")
    for _ in range(rounds):
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: the smaller neighbours of a node, and the node itself, hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(least, "u")
            .where("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(least.select("u", F.col("low").alias("v")))
            .distinct()
        )
        after = materialise(small, "edges")
        # settled when every node hangs on one node only, and that node hangs on none
        tops = after.select(F.col("v").alias("u")).distinct()
        open_ = after.groupBy("u").agg(F.count_distinct("v").alias("n")).where("n > 1").select("u").unionByName(after.join(tops, "u", "left_semi").select("u"))
        now = after
        if open_.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def extended(placed: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after further links (a, b), stored. Only the links between components are contracted anew, not those
    that made ``placed``."""
    if placed is None:
        return materialise(connected_components(links), "components")
    ends = links
    for c in ("a", "b"):
        near = placed.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
        ends = ends.join(near, c, "left")
    between = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b").distinct()
    moved = materialise(connected_components(between), "components")
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = placed.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    new = moved.join(placed.select("node"), "node", "left_anti").select("node", "component")
    return materialise(old.unionByName(new), "components")
