"""Graph operators: connected components by iterated joins."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.session import cut, skew_join


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge: (node, component).

    Alternates large-star and small-star contraction (each a groupBy with a
    map-side minimum and an equi-join), so rounds grow with the logarithm of
    the graph. A node with a large share of all edges is joined by broadcast, so
    no component is gathered in one task. Self loops and null ends are ignored;
    no edges give no rows.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    pairs = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        # Large star: every larger neighbour of u goes to the least of u and its neighbours.
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k")).select("u", F.least("u", "m").alias("m"), "k")
        pairs = cut(skew_join(both.where("v > u"), least, ["u"], "k").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: u and its smaller neighbours go to the least of them.
        least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
        moved = skew_join(pairs, least, ["u"], "k").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
        if _is_star_forest(pairs):
            break
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()


def _is_star_forest(pairs: DataFrame) -> bool:
    """Whether every u has a single v, and no v is a u elsewhere."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("v", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def routes(edges: DataFrame, start: str, terminals: tuple[str, ...], max_edges: int = 10_000) -> DataFrame:
    """All edge-simple paths from ``start`` to a terminal over (edge_id, a, b): a frontier of paths, one join a step.

    For workflow graphs, whose size does not grow with the data: more than
    ``max_edges`` edges are an error. Ends when no path can go on, which is at
    the latest after as many steps as there are edges.
    """
    n = edges.limit(max_edges + 1).count()
    if n > max_edges:
        raise ValueError(f"a workflow of more than {max_edges} edges")
    e = F.broadcast(edges.select("edge_id", "a", "b"))
    front = edges.sparkSession.createDataFrame([(start, [])], "node string, path array<int>")
    done = front.where("false")
    for _ in range(n):
        front = front.join(e, F.col("node") == F.col("a")).where(~F.array_contains("path", F.col("edge_id")))
        front = cut(front.select(F.col("b").alias("node"), F.concat("path", F.array("edge_id")).alias("path")))
        done = done.union(front.where(F.col("node").isin(*terminals)))
        if front.isEmpty():
            break
    return done.select("node", F.size("path").alias("steps"), F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("route"))


def reachable(edges: DataFrame, start: str) -> DataFrame:
    """Nodes reached from ``start`` and the least number of steps to each; ends when a step reaches no new node."""
    seen = edges.sparkSession.createDataFrame([(start, 0)], "node string, steps int")
    front = seen
    for step in count(1):
        front = cut(front.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("steps", F.lit(step)))
        if front.isEmpty():
            break
        seen = cut(seen.union(front))
    return seen


def lint(edges: DataFrame, start: str, terminals: tuple[str, ...]) -> DataFrame:
    """(finding, node): dead ends that are no terminal, nodes nothing leads to, terminals that go on."""
    out = edges.select(F.col("a").alias("node")).distinct()
    into = edges.select(F.col("b").alias("node")).distinct()
    dead = into.join(out, "node", "left_anti").where(~F.col("node").isin(*terminals)).select(F.lit("dead_end").alias("finding"), "node")
    lost = out.join(into, "node", "left_anti").where(F.col("node") != start).select(F.lit("unreached").alias("finding"), "node")
    on = out.where(F.col("node").isin(*terminals)).select(F.lit("terminal_goes_on").alias("finding"), "node")
    return dead.union(lost).union(on)
