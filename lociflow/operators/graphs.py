"""Graphs as edge lists: connected components, and the spanning forest that single linkage is made of. Both contract: no
neighbour list is gathered, and every round leaves half of the components with an edge at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociflow.functions.lineage import counted, kept


def _both_ways(edges: DataFrame, *more: str) -> DataFrame:
    side = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("next"), *more)
    return edges.select(F.inline(F.array(side("a", "b"), side("b", "a"))))


def _followed(parent: DataFrame) -> DataFrame:
    """node, root of parent(node, root): parents are followed to their ends, the path halving each time."""
    moved = 1
    while moved:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        step = parent.join(up, "root", "left").select("node", "root", F.coalesce("_up", "root").alias("_up"))
        step, seen = counted(step, moved=(F.col("_up") != F.col("root")).cast("int"))
        parent, moved = step.select("node", F.col("_up").alias("root")), seen["moved"]
    return parent


def _renamed(edges: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """Edges between different roots."""
    a, b = (roots.select(F.col("node").alias(k), F.col("root").alias(f"_{k}")) for k in "ab")
    out = edges.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"), *more)
    return out.where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of every node of `edges`(a, b), both long, that has an edge to another."""
    left, seen = counted(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    out = None
    while seen["rows"]:
        parent = _both_ways(left).groupBy("node").agg(F.min("next").alias("next")).select("node", F.least("node", "next").alias("root"))
        parent = _followed(kept(parent))
        out = parent if out is None else kept(out.join(parent.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
        left, seen = counted(_renamed(left, parent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return out if out is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))


def spanning_forest(edges: DataFrame) -> DataFrame:
    """a, b, weight of the edges of the least spanning forest of `edges`(a, b, weight): equal weights go by the ends.

    Borůvka's rounds: each component takes its least edge, components joined so become one, and the edges between what is left go
    on, of parallel ones the least. The order of edges is total, so the edges taken make no cycle but the pairs that chose each
    other, of which the smaller is the root."""
    least, most = F.least("a", "b"), F.greatest("a", "b")
    order = F.struct("weight", least.alias("x"), most.alias("y")).alias("edge")  # the original ends tell equal weights apart
    left, seen = counted(edges.where("a <> b").select(least.alias("a"), most.alias("b"), order).groupBy("a", "b").agg(F.min("edge").alias("edge")))
    out = left.select(F.col("edge.x").alias("a"), F.col("edge.y").alias("b"), F.col("edge.weight").alias("weight")).where("false")
    while seen["rows"]:
        chosen = kept(_both_ways(left, "edge").groupBy("node").agg(F.min(F.struct("edge", "next")).alias("m")).select("node", F.col("m.next").alias("next"), F.col("m.edge").alias("edge")))
        out = out.union(chosen.select("edge.*").distinct().select(F.col("x").alias("a"), F.col("y").alias("b"), "weight"))
        # A component hangs under what it chose, unless both chose each other and it is the smaller.
        back = chosen.select(F.col("node").alias("next"), F.col("next").alias("_back"))
        parent = chosen.join(back, "next").select("node", F.when((F.col("_back") == F.col("node")) & (F.col("node") < F.col("next")), F.col("node")).otherwise(F.col("next")).alias("root"))
        roots = _followed(kept(parent))
        renamed = _renamed(left, roots, "edge").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "edge")
        left, seen = counted(renamed.groupBy("a", "b").agg(F.min("edge").alias("edge")))
    return out


def near_pairs(points: DataFrame, radius: float, dims: int, by: list[str] | None = None) -> DataFrame:
    """a, b, weight: pairs of points(id, vector, and `by`) up to `radius` apart, by cells of a grid over the first `dims` components.

    Each point is sent to its own cell and its neighbours'; a pair meets in the cell of its smaller id."""
    by = by or []
    cell = [F.floor(F.get("vector", F.lit(k)) / radius) for k in range(dims)]
    own = points.select(*by, "id", "vector", F.array(*cell).alias("cell"))
    offsets = [[]]
    for _ in range(dims):
        offsets = [[*o, d] for o in offsets for d in (-1, 0, 1)]
    moved = F.array(*(F.array(*(F.get("cell", F.lit(k)) + d for k, d in enumerate(o))) for o in offsets))
    other = own.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("id").alias("_id"), F.col("vector").alias("_vector"), F.explode(moved).alias("_cell"))
    same = (F.col("cell") == F.col("_cell")) & (F.col("id") < F.col("_id"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    square = F.aggregate(F.zip_with("vector", "_vector", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    return own.join(other, same).select(F.col("id").alias("a"), F.col("_id").alias("b"), F.sqrt(square).alias("weight")).where(F.col("weight") <= radius)


def merge_steps(forest: DataFrame, nodes: DataFrame) -> DataFrame:
    """root, step, height of the merges of single linkage, by height, from a spanning forest and its nodes(id): a component of m nodes has
    m - 1 of them. Steps are numbered in a component, so a window holds one component's edges, rows of three numbers."""
    roots = components(forest)
    t = forest.join(roots.withColumnRenamed("node", "a"), "a").select("root", F.col("weight").alias("height"), "a", "b")
    return t.withColumn("step", F.row_number().over(Window.partitionBy("root").orderBy("height", "a", "b")) - 1).select("root", "step", "a", "b", "height")


def flat_clusters(forest: DataFrame, nodes: DataFrame, height: float) -> DataFrame:
    """id, cluster (its smallest id): what single linkage has merged up to `height`."""
    roots = components(forest.where(F.col("weight") <= height))
    return nodes.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("cluster"))
