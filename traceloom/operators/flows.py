"""Workflow routes: edges seen in data, continuity and bound values of steps, causal graphs with milestones, cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import cut


def seen_edges(pairs: DataFrame, least: int = 1) -> DataFrame:
    """(edge_id, a, b): the pairs (a, b) found ``least`` times or more, numbered from 1 in order.

    Pairs are counted before they are numbered, so the window holds a workflow's
    edges, not rows. Null ends are left out. The edges are written, so walks
    over them, one join a step, do not count the pairs again.
    """
    found = pairs.where("a IS NOT NULL AND b IS NOT NULL").groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return cut(found.select(F.row_number().over(Window.orderBy("a", "b")).alias("edge_id"), "a", "b"))


def continuity(steps: DataFrame, gives: DataFrame, needs: DataFrame, initial: DataFrame, starts: tuple[str, ...] = (), terminals: tuple[str, ...] = ()) -> DataFrame:
    """(route, pos, finding, what): where routes break off or use what is not there yet.

    ``steps`` are (route, pos, a, b), ``gives`` and ``needs`` (route, pos, slot),
    ``initial`` (route, slot). Findings: ``discontinuous``, a step that does not
    begin where the one before ended; ``starts elsewhere`` and ``ends
    elsewhere`` where such states are given; ``given twice``, a slot that is
    already there; ``unbound``, a slot needed before a step gave it. A step that
    needs what it gives itself is unbound. Routes without steps have no findings
    of steps. Values are matched by joins on (route, slot); only one route's
    steps meet in a window.
    """
    along = Window.partitionBy("route").orderBy("pos")
    s = steps.withColumn("before", F.lag("b").over(along)).withColumn("after", F.lead("b").over(along))
    find = lambda df, finding, what: df.select("route", "pos", F.lit(finding).alias("finding"), F.col(what).alias("what"))
    out = find(s.where("before IS NOT NULL AND NOT a <=> before"), "discontinuous", "a")
    if starts:
        out = out.union(find(s.where(F.col("before").isNull() & ~F.coalesce(F.col("a").isin(*starts), F.lit(False))), "starts elsewhere", "a"))
    if terminals:
        out = out.union(find(s.where(F.col("after").isNull() & ~F.coalesce(F.col("b").isin(*terminals), F.lit(False))), "ends elsewhere", "b"))
    have = gives.select("route", "slot", "pos").unionByName(initial.select("route", "slot", F.lit(None).cast(gives.schema["pos"].dataType).alias("pos")).distinct())
    order = F.row_number().over(Window.partitionBy("route", "slot").orderBy(F.asc_nulls_first("pos")))
    have = have.withColumn("n", order)
    out = out.union(find(have.where("n > 1"), "given twice", "slot"))
    first = have.where("n = 1").select("route", "slot", F.col("pos").alias("since"), F.lit(1).alias("there"))
    used = needs.distinct().join(first, ["route", "slot"], "left")
    return out.union(find(used.where("there IS NULL OR since >= pos"), "unbound", "slot"))


def causal_graph(actions: DataFrame) -> DataFrame:
    """(episode, ordinal, state, on_ok, on_empty, on_error, milestones) of actions (episode, pos, kind, label, status).

    ``kind`` is ask, tool, final or refusal; states are numbered from 1. A tool's
    result of status ok leads to the next state; another one too, unless that
    is a tool as well: then it leads to the episode's last state. Asks and ends
    have one way, in ``on_ok``. Milestones are what the recorded path earns: the
    ask, or the call, its round and the branch of its status, or the completion.
    """
    along = Window.partitionBy("episode").orderBy("pos")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.format_string("%02d", F.row_number().over(along))
    name = F.when(F.col("kind").isin("ask", "tool"), F.concat_ws("_", "kind", "n", "label")).otherwise(F.concat_ws("_", "kind", "n"))
    s = actions.withColumn("n", n).withColumn("state", name).withColumn("ordinal", F.row_number().over(along))
    s = s.withColumn("next", F.coalesce(F.lead("state").over(along), F.lit("done"))).withColumn("then", F.lead("kind").over(along)).withColumn("end", F.last("state").over(whole))
    other = F.when(F.col("kind") == "tool", F.when(F.col("then") == "tool", F.col("end")).otherwise(F.col("next")))
    tag = F.concat_ws("_", "n", "label")
    earned = (
        F.when(F.col("kind") == "ask", F.array("state"))
        .when(F.col("kind") == "tool", F.array(F.concat(F.lit("call_"), tag, F.lit("_01")), F.concat(F.lit("round_"), tag), F.concat(F.lit("branch_"), tag, F.lit("_"), F.col("status"))))
        .otherwise(F.array(F.concat(F.lit("valid_"), "kind", F.lit("_"), "n"))))
    return s.select("episode", "ordinal", "state", F.col("next").alias("on_ok"), other.alias("on_empty"), other.alias("on_error"), earned.alias("milestones"))


def replay(graph: DataFrame, results: DataFrame, max_steps: int = 1000) -> DataFrame:
    """(episode, steps, last): how far each episode comes in its graph when the tools answer with ``results`` (episode, state, status).

    All episodes go one step a round, by a join; a state without a result
    answers ok. An episode ends at ``done``; one that comes to a state twice is
    an error, as is one that takes more than ``max_steps``.
    """
    ways = cut(graph.join(results, ["episode", "state"], "left").select("episode", "state", F.when(F.col("status") == "empty", F.col("on_empty")).when(F.col("status") == "error", F.col("on_error")).otherwise(F.col("on_ok")).alias("to"), "ordinal"))
    at = ways.where("ordinal = 1").select("episode", "state", F.lit(0).alias("steps"), F.lit(0).alias("passed"))
    done = at.where("false").select("episode", "steps", F.col("state").alias("last"))
    for _ in range(max_steps):
        moved = cut(at.join(ways, ["episode", "state"]).select("episode", F.col("to").alias("next"), (F.col("steps") + 1).alias("steps"), F.col("ordinal").alias("passed"), F.col("state").alias("last")))
        done = done.union(moved.where("next = 'done'").select("episode", "steps", "last"))
        at = moved.where("next <> 'done'").select("episode", F.col("next").alias("state"), "steps", "passed")
        if not at.join(ways, ["episode", "state"]).where("ordinal <= passed").isEmpty():
            raise ValueError("a state comes twice in one path")
        if at.isEmpty():
            return done
    raise ValueError(f"an episode of more than {max_steps} steps")


def cyclic(edges: DataFrame) -> DataFrame:
    """(node): nodes on cycles or on a way from one cycle to another, over (a, b); none if the graph has no cycle.

    Nodes without a way in, and those without a way out, are peeled off until
    none is left. A round is two joins by shuffle; there are as many rounds as
    the longest way into or out of the cycles. Self loops are cycles.
    """
    left = cut(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct())
    n = left.count()
    while n:
        left = cut(left.join(left.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(left.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b"))
        n, before = left.count(), n
        if n == before:
            break
    return left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
