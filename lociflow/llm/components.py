"""Connected components of a distributed edge list, by contraction: no adjacency list is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import counted, stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for every node of `edges`(a, b), both long.

    Each round every root takes the smallest root next to it as its parent, parents are followed to their ends, and the
    edges are rewritten between what is left: at least every second root with a neighbour goes."""
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left, seen = counted(edges.where("a <> b").select(*ordered).distinct())
    out = None
    while seen["rows"]:
        both = left.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("next")), F.struct(F.col("b").alias("node"), F.col("a").alias("next")))))
        parent = stored(both.groupBy("node").agg(F.min("next").alias("next")).select("node", F.least("node", "next").alias("root")))
        moved = 1
        while moved:  # the path to the root halves each time
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            step = parent.join(up, "root", "left").select("node", "root", F.coalesce("_up", "root").alias("_up"))
            step, seen = counted(step, moved=(F.col("_up") != F.col("root")).cast("int"))
            parent, moved = step.select("node", F.col("_up").alias("root")), seen["moved"]
        if out is None:
            out = parent
        else:
            known = out.join(parent.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root", "left")
            out = stored(known.select("node", F.coalesce("_up", "root").alias("root")))
        a, b = (parent.select(F.col("node").alias(k), F.col("root").alias(f"_{k}")) for k in "ab")
        moved_edges = left.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        left, seen = counted(moved_edges.where("a <> b").select(*ordered).distinct())
    return out if out is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
