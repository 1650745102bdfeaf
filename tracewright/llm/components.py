"""Connected components by random-mate contraction in SQL joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.session import durable


def _contract(edges: DataFrame, parent: DataFrame) -> DataFrame:
    """Edges between the contracted vertices: distinct, without loops, smaller end first."""
    at_u = parent.select(F.col("child").alias("u"), F.col("parent").alias("pu"))
    at_v = parent.select(F.col("child").alias("v"), F.col("parent").alias("pv"))
    moved = edges.join(at_u, "u", "left").join(at_v, "v", "left").select(F.coalesce("pu", "u").alias("u"), F.coalesce("pv", "v").alias("v"))
    return moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("e")).select("e.x", "e.y")


def _coins(edges: DataFrame, seed: int, number: int) -> DataFrame:
    """child, parent: vertices whose coin shows tails collapse into their smallest neighbour with heads.

    Coins are weighted and mated: a vertex of degree d draws u ** (1 / d ** 2) from a uniform u and shows
    heads if no neighbour draws more.  So all leaves of a star go in a round but for a chance of 1 / d,
    however large it is, and of a path's vertices two thirds; some vertex always goes."""
    ways = _both_ways(edges)
    u = (F.pmod(F.xxhash64("x", F.lit(seed), F.lit(number)), F.lit(1 << 40)) + 1) / F.lit(float((1 << 40) + 1))
    drawn = ways.groupBy("x").agg(F.count(F.lit(1)).alias("d")).select("x", F.struct((F.log(u) / F.pow("d", F.lit(2))).alias("draw"), F.col("x").alias("name")).alias("draw"))
    best = ways.join(drawn.withColumnsRenamed({"x": "y", "draw": "other"}), "y").groupBy("x").agg(F.max("other").alias("other"))
    coin = durable(drawn.join(best, "x").select("x", (F.col("draw") > F.col("other")).alias("heads")))
    tails, heads = coin.where("not heads").select("x"), coin.where("heads").select(F.col("x").alias("y"))
    return ways.join(heads, "y", "left_semi").groupBy(F.col("x").alias("child")).agg(F.min("y").alias("parent")).join(tails.select(F.col("x").alias("child")), "child", "left_semi")


def contract(edges: DataFrame, seed: int = 7, max_rounds: int = 400) -> list[DataFrame]:
    """The collapses (child, parent) of each round until no edge is left."""
    left = durable(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    steps: list[DataFrame] = []
    for number in range(max_rounds):
        collapse = durable(_coins(left, seed, number))
        if not collapse.isEmpty():
            steps.append(collapse)
            left = durable(_contract(left, collapse))
        elif left.isEmpty():
            return steps
    raise RuntimeError("contraction did not end")


def components(edges: DataFrame, seed: int = 7) -> DataFrame:
    """(vertex, component) of the undirected edges (u, v); a component is named by its smallest vertex.

    In each round every vertex throws a coin and tails collapse into neighbouring heads; expected rounds
    grow as the logarithm of the vertices.  When no edge is left the collapses are unwound from the last to
    the first.  All state lives in checkpointed tables; hot vertices meet a join side of one row, which
    adaptive execution splits.  Null ends, loops and repeated edges are ignored except that the vertex
    of a loop gets its own component; no edges give an empty result.
    """
    edges = edges.select("u", "v").where("u is not null and v is not null")
    vertices = durable(_both_ways(edges).select(F.col("x").alias("vertex")).distinct())
    label: DataFrame | None = None
    for collapse in reversed(contract(edges, seed)):  # what collapsed last is labelled first
        if label is None:
            label = collapse.select(F.col("child").alias("vertex"), F.col("parent").alias("root"))
        else:
            up = label.select(F.col("vertex").alias("parent"), F.col("root").alias("above"))
            here = collapse.join(up, "parent", "left").select(F.col("child").alias("vertex"), F.coalesce("above", "parent").alias("root"))
            label = durable(label.unionByName(here))
    if label is None:
        return vertices.select("vertex", F.col("vertex").alias("component"))
    full = vertices.join(label, "vertex", "left").select("vertex", F.coalesce("root", "vertex").alias("root"))
    names = full.groupBy("root").agg(F.min("vertex").alias("component"))
    return full.join(names, "root").select("vertex", "component")
