"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v); the component is its smallest node.

    Every round writes its edges to the shared folder. Rounds grow with the logarithm of the
    longest path. Raises if ``max_rounds`` were not enough.
    """
    now = shared.table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        now = shared.table(large.join(small, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merge_components(component: DataFrame, edges: DataFrame) -> DataFrame:
    """Components (node, component) after further edges: only the components that the edges touch are settled again."""
    names = component.select(F.col("node"), F.col("component"))
    at = lambda c: names.select(F.col("node").alias(c), F.col("component").alias(f"{c}_c"))
    lifted = edges.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("u_c", "u").alias("u"), F.coalesce("v_c", "v").alias("v"))
    moved = connected_components(lifted).select(F.col("node").alias("component"), F.col("component").alias("to"))
    new = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(names, "node", "left_anti").select("node", F.col("node").alias("component"))
    return names.unionByName(new).join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
