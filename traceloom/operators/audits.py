"""Audits of joins, sets, paths and consistency, each as rows of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys match once on both sides, repeat on either, or are missing from one."""
    a, b = (d.groupBy(key).agg(F.count("*").alias(n)) for d, n in ((left, "a"), (right, "b")))
    status = F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right").when((F.col("a") > 1) | (F.col("b") > 1), "repeated").otherwise("matched")
    return a.join(b, key, "full").groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.min(key).alias("least_key"))


def call_results(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Calls (orders) against results (lines): calls without one, results without a call, numbers that repeat or leave gaps."""
    calls = orders.select(F.col("o_orderkey").alias("id"), F.lit(1).alias("called"))
    numbers = F.col("l_linenumber")
    results = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"), F.countDistinct(numbers).alias("distinct"), F.max(numbers).alias("top"))
    status = F.when(F.col("n").isNull(), "no_result").when(F.col("called").isNull(), "no_call").when(F.col("distinct") < F.col("n"), "repeated").when(F.col("top") != F.col("n"), "gap").otherwise("ok")
    return calls.join(results, "id", "full").groupBy(status.alias("status")).agg(F.count("*").alias("n_calls"))


def by_position(lines: DataFrame) -> DataFrame:
    """An order's returned lines beside its others, position by position; the shorter side is empty."""
    pos = F.row_number().over(Window.partitionBy("l_orderkey", "side").orderBy("l_linenumber", "l_partkey")).alias("pos")
    r = lines.withColumn("side", F.coalesce(F.col("l_returnflag") == "R", F.lit(False))).select("l_orderkey", "side", pos, F.col("l_partkey").alias("p"))
    a, b = (r.where(c).select("l_orderkey", "pos", F.col("p").alias(n)) for c, n in (("side", "returned"), ("NOT side", "other")))
    return a.join(b, ["l_orderkey", "pos"], "full")


def set_difference(lines: DataFrame, key: str = "l_suppkey") -> DataFrame:
    """Keys of the returned lines and of the others: how many are on one side only."""
    a, b = (lines.where(f"{n} (l_returnflag = 'R')").select(key).distinct() for n in ("", "NOT"))
    return a.exceptAll(b).select(F.lit("only_returned").alias("side"), key).union(b.exceptAll(a).select(F.lit("only_other"), key)).groupBy("side").agg(F.count("*").alias("n"))


def single_result(lines: DataFrame) -> DataFrame:
    """Keys (part and supplier) that were answered with more than one price."""
    return lines.groupBy("l_partkey", "l_suppkey").agg(F.countDistinct("l_extendedprice").alias("n_results")).where("n_results > 1")


def branch_gaps(edges: DataFrame, tools: tuple[str, ...], statuses: tuple[str, ...] = ("ok", "empty", "error")) -> DataFrame:
    """(tool, status, n) of every tool and status without exactly one branch, over (edge_id, a, b)."""
    spark = edges.sparkSession
    want = spark.createDataFrame([(t, s) for t in tools for s in statuses], "tool string, status string")
    seen = edges.groupBy(F.col("a").alias("tool"), F.col("b").alias("status")).agg(F.count("*").alias("n"))
    return want.join(seen, ["tool", "status"], "left").select("tool", "status", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def _in_order():
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


def causal_path(events: DataFrame) -> DataFrame:
    """Each call as a numbered state and the state it leads to, ``end`` after the last."""
    at = F.format_string("%s_%02d", "event_type", F.row_number().over(_in_order()))
    s = events.select("event_id", "user_id", "ts", at.alias("state"))
    return s.select("event_id", "state", F.coalesce(F.lead("state").over(_in_order()), F.lit("end")).alias("next_state"))


def unbound_uses(events: DataFrame, source: str = "view", use: str = "purchase") -> DataFrame:
    """Per user, uses with no source call before them."""
    before = _in_order().rowsBetween(Window.unboundedPreceding, -1)
    had = F.coalesce(F.max((F.col("event_type") == source).cast("int")).over(before), F.lit(0))
    return events.withColumn("had", had).groupBy("user_id").agg(F.count_if(F.col("event_type") == use).alias("uses"), F.count_if((F.col("event_type") == use) & (F.col("had") == 0)).alias("unbound"))


def milestones(events: DataFrame, plan: tuple[str, ...] = ("view", "click", "purchase")) -> DataFrame:
    """Per user, how many milestones a replay of its calls credits in the order of ``plan``, and the ratio (1 without a plan)."""
    # Each milestone is the first call of its type after the milestone before.
    marks = events.select("user_id", "event_type", F.row_number().over(_in_order()).alias("pos"))
    for i, kind in enumerate(plan):
        after = F.lit(0) if i == 0 else F.col(f"m{i - 1}")
        here = F.min(F.when((F.col("event_type") == kind) & (F.col("pos") > after), F.col("pos"))).over(Window.partitionBy("user_id"))
        marks = marks.withColumn(f"m{i}", here)
    credit = sum((F.max(f"m{i}").isNotNull().cast("long") for i in range(len(plan))), F.lit(0).cast("long"))
    done = marks.groupBy("user_id").agg(credit.alias("credited"))
    return done.select("user_id", "credited", F.round(F.col("credited") / len(plan) if plan else F.lit(1.0), 6).alias("ratio"))


def route_catalog(events: DataFrame, steps: int | None = 3) -> DataFrame:
    """Routes by the first ``steps`` actions of a user, or all without a number: number of users and the least of them."""
    e = events.withColumn("pos", F.row_number().over(_in_order()))
    e = e if steps is None else e.where(F.col("pos") <= steps)
    route = F.expr("array_join(transform(array_sort(collect_list(struct(pos, event_type))), x -> x.event_type), '>')")
    return e.groupBy("user_id").agg(route.alias("route")).groupBy("route").agg(F.count("*").alias("n_users"), F.min("user_id").alias("least_user"))


def runs(events: DataFrame, kind: str = "view") -> DataFrame:
    """Unbroken runs of one type in a user's calls: first and last position."""
    e = events.select("user_id", "event_type", F.row_number().over(_in_order()).alias("pos")).where(F.col("event_type") == kind)
    e = e.withColumn("island", F.col("pos") - F.row_number().over(Window.partitionBy("user_id").orderBy("pos")))
    return e.groupBy("user_id", "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last")).drop("island")


def first_differing(lines: DataFrame, fields: tuple[str, ...] = ("l_discount", "l_linestatus", "l_quantity", "l_returnflag", "l_tax")) -> DataFrame:
    """The first field by name in which the first two lines of an order differ; null if none does."""
    a, b = (lines.where(F.col("l_linenumber") == n).select("l_orderkey", F.struct(*fields).alias(s)) for n, s in ((1, "a"), (2, "b")))
    differ = [F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), F.lit(f)) for f in fields]
    return a.join(b, "l_orderkey").select("l_orderkey", F.array_min(F.array_compact(F.array(*differ))).alias("field"))


def date_series(orders: DataFrame, days: int = 3) -> DataFrame:
    """Each order's day and those after it, counted by day."""
    day = F.to_date("o_orderdate")
    return orders.select(F.explode(F.sequence(day, F.date_add(day, days - 1))).alias("day")).groupBy("day").agg(F.count("*").alias("n"))


def topic_rotation(orders: DataFrame, topics: tuple[str, ...] = ("price", "time", "place")) -> DataFrame:
    """Topics dealt in turn to the orders of each priority and day."""
    w = Window.partitionBy("o_orderpriority", F.to_date("o_orderdate")).orderBy("o_orderkey")
    return orders.select("o_orderkey", F.element_at(F.array(*map(F.lit, topics)), F.pmod(F.row_number().over(w) - 1, F.lit(len(topics))) + 1).alias("topic"))


def status_fold(events: DataFrame) -> DataFrame:
    """A user-day's status: error before empty (no purchase) before ok."""
    rank = F.max(F.when(F.col("event_type") == "error", 2).otherwise(0))
    empty = F.when(F.count_if(F.col("event_type") == "purchase") == 0, 1).otherwise(0)
    d = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.greatest(rank, empty).alias("r"))
    return d.groupBy(F.when(F.col("r") == 2, "error").when(F.col("r") == 1, "empty").otherwise("ok").alias("status")).agg(F.count("*").alias("n"))


def training_rows(messages: DataFrame, most: int = 64, multiple: int = 8, ignore: int = -100) -> DataFrame:
    """Per conversation, word labels (the turn on assistant words, else ``ignore``), cut on the left to ``most`` and padded on the right."""
    n = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    label = F.when(F.col("role") == "assistant", F.col("turn").cast("int")).otherwise(ignore)
    m = messages.select("conv_id", F.struct("turn", F.array_repeat(label, n).alias("labels")).alias("x"))
    labels = m.groupBy("conv_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["labels"])).alias("all"))
    kept = labels.withColumn("kept", F.when(F.size("all") > most, F.slice("all", -most, most)).otherwise(F.col("all")))
    padded = F.concat("kept", F.array_repeat(F.lit(ignore), F.pmod(-F.size("kept"), F.lit(multiple))))
    return kept.select("conv_id", F.size("all").alias("n_words"), F.size("kept").alias("n_kept"), F.array_join(padded.cast("array<string>"), ",").alias("labels"))
