"""Scoring and roll-ups over calls (user_id, event_type, value, ts): slices, gates, rewards, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.operators.ranks import running
from traceloom.session import cut


def nearest_rank(q: float, column: str):
    """The value at rank max(0, ceil(q * n) - 1), nulls left out."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})")


def slice_summary(events: DataFrame) -> DataFrame:
    """Count, success rate and nearest-rank percentiles overall and by each dimension on its own.

    Values are counted before they are ranked, and the ranks of the slice over
    everything are taken in ranges of values, not in one task. Null values
    count as rows but have no rank.
    """
    e = events.select((F.col("user_id") % 5).alias("bucket"), "event_type", "value")
    counts = cut(_counted(e))
    ranked = running(counts.where("value IS NOT NULL"), ["slice"], ["value"], "rows")
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("value")))
    ranks = ranked.groupBy("slice").agg(at(0.5).alias("p50"), at(0.95).alias("p95"))
    totals = counts.groupBy("slice", "bucket", "event_type").agg(F.sum("rows").alias("n"), F.sum("ok").alias("n_ok"))
    return totals.join(ranks, "slice", "left").drop("slice")


def _counted(e: DataFrame) -> DataFrame:
    """(slice, bucket, event_type, value, rows, ok): how often a value occurs in each slice."""
    per = e.groupBy("bucket", "event_type", "value").agg(F.count("*").alias("rows"), F.count_if(F.col("event_type") != "error").alias("ok"))
    none, kind = F.lit(None), lambda k, b, t: F.struct(F.lit(k).alias("kind"), b.cast("long").alias("bucket"), t.cast("string").alias("event_type"))
    slices = F.array(kind("all", none, none), kind("bucket", F.col("bucket"), none), kind("type", none, F.col("event_type")))
    long = per.select(F.explode(slices).alias("s"), "value", "rows", "ok")
    return long.groupBy(F.to_json("s").alias("slice"), "s.bucket", "s.event_type", "value").agg(F.sum("rows").alias("rows"), F.sum("ok").alias("ok"))


def pooled_and_averaged(events: DataFrame) -> DataFrame:
    """Per user: calls pooled over days against the mean of daily rates; a day without required calls counts as 1."""
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") != "view").alias("required"), F.count_if(F.col("event_type") == "purchase").alias("correct"))
    rate = F.when(F.col("required") == 0, 1.0).otherwise(F.col("correct") / F.col("required"))
    return daily.groupBy("user_id").agg(F.when(F.sum("required") == 0, 1.0).otherwise(F.sum("correct") / F.sum("required")).alias("pooled"), F.avg(rate).alias("averaged"), F.count("*").alias("n_days"))


def cost_per_task(lines: DataFrame, price_in: float = 2.5, price_out: float = 10.0) -> DataFrame:
    """Tokens priced per million and summed by task: quantities stand for tokens, orders for tasks."""
    t = lines.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("tokens_in"), F.count("*").alias("tokens_out"))
    return t.select("l_orderkey", "tokens_in", "tokens_out", (F.col("tokens_in") * price_in / 1e6 + F.col("tokens_out") * price_out / 1e6).alias("cost"))


def metrics_long(events: DataFrame) -> DataFrame:
    """Minimum, maximum and number of a type's values as (metric, value) rows."""
    a = events.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").cast("double").alias("n"))
    return a.select("event_type", F.expr("stack(3, 'min', lo, 'max', hi, 'count', n) AS (metric, value)"))


def endpoint_validity(events: DataFrame) -> DataFrame:
    """A user-day is valid if its hours of activity, numbered from the first, have no gap."""
    hours = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set(F.hour("ts"))).alias("h"))
    whole = F.col("h") == F.expr("sequence(h[0], h[size(h) - 1])")
    return hours.groupBy("user_id").agg(F.count_if(whole).alias("n_valid"), F.count("*").alias("n_days"))


def gates(events: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """Whether each metric passes its bound: rules of (metric, operator, bound)."""
    m = events.agg(F.count("*").cast("double").alias("n"), (F.count_if(F.col("event_type") == "error") / F.count("*")).alias("error_rate"), F.max("value").alias("max_value"))
    long = m.select(F.expr("stack(3, 'n', n, 'error_rate', error_rate, 'max_value', max_value) AS (metric, value)"))
    r = events.sparkSession.createDataFrame(rules, "metric string, op string, bound double")
    ok = F.expr("CASE op WHEN '>' THEN value > bound WHEN '>=' THEN value >= bound WHEN '<' THEN value < bound WHEN '<=' THEN value <= bound ELSE value = bound END")
    return long.join(F.broadcast(r), "metric").select("metric", "op", "bound", F.when(ok, "PASS").otherwise("FAIL").alias("status"))


def upsert(board: DataFrame, runs: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Rows of ``board`` (id, key, value) overwritten by ``runs`` (key, value) with their id kept; new keys get the ids after the largest.

    Of several runs of a key the last one by ``order`` counts, or, without it,
    by value, so a key has one row. ``board`` has one row a key.
    """
    last = runs.groupBy(key).agg(F.max_by(value, F.struct(*([order] if order else []), value)).alias(value))
    new = last.join(board.select(key), key, "left_anti")
    top = board.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    placed = running(new.withColumn("one", F.lit(1)), [], [key], "one")
    added = placed.crossJoin(F.broadcast(top)).select((F.col("top") + F.col("upto")).cast("int").alias("id"), key, value)  # top is one row
    kept = board.join(last.select(key, F.col(value).alias("__new")), key, "left").select("id", key, F.coalesce("__new", value).alias(value))
    return kept.unionByName(added)


def gated_reward(events: DataFrame) -> DataFrame:
    """Success-gated reward: max(0.5, 1.5 - 0.2 * violations) where the goal was reached, else 0."""
    per = events.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("goal"), F.count_if(F.col("event_type") == "error").alias("u"))
    return per.select("user_id", "goal", "u", F.when(F.col("goal"), F.greatest(F.lit(0.5), 1.5 - 0.2 * F.col("u"))).otherwise(0.0).alias("reward"))


def difficulty(events: DataFrame) -> DataFrame:
    """solved if all attempts (user-days) succeed, unsolved if none does, else mixed."""
    tries = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.bool_or(F.col("event_type") == "purchase").alias("won"))
    kind = F.when(F.bool_and("won"), "solved").when(~F.bool_or("won"), "unsolved").otherwise("mixed")
    return tries.groupBy("user_id").agg(kind.alias("category"), F.count("*").alias("attempts"))


def lcs_length(golden: str, made: str):
    """Length of the longest common subsequence of two array columns, by folding rows of the table."""
    row = (
        f"aggregate({golden}, transform({made}, x -> 0), (prev, g) -> "
        f"aggregate({made}, named_struct('row', cast(array() AS array<int>), 'j', 0, 'left', 0), (s, m) -> named_struct("
        "'row', s.row || array(CASE WHEN g = m THEN (CASE WHEN s.j = 0 THEN 0 ELSE prev[s.j - 1] END) + 1 ELSE greatest(s.left, prev[s.j]) END), 'j', s.j + 1,"
        " 'left', CASE WHEN g = m THEN (CASE WHEN s.j = 0 THEN 0 ELSE prev[s.j - 1] END) + 1 ELSE greatest(s.left, prev[s.j]) END), s -> s.row))"
    )
    return F.expr(f"CASE WHEN size({golden}) = 0 OR size({made}) = 0 THEN 0 ELSE element_at({row}, -1) END")


def lcs_credit(events: DataFrame) -> DataFrame:
    """Per user: the calls of its first day against those of its last, matched in order."""
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.expr("transform(array_sort(collect_list(struct(ts, event_id, event_type))), x -> x.event_type)").alias("calls"))
    both = daily.groupBy("user_id").agg(F.min_by("calls", "day").alias("golden"), F.max_by("calls", "day").alias("made"))
    return both.select("user_id", F.size("golden").alias("required"), F.size("made").alias("made"), lcs_length("golden", "made").alias("matched"))
