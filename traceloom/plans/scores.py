"""Queries of the scorer: made calls against required ones, from single calls to slices, with their SQL.

The required calls of a segment are a user's events of one day. The made ones
are these with faults put in by rule, so that every reason occurs: in every
fourth user's segments the first call comes last; elsewhere calls are left out,
have other or unreadable arguments, an alias, or an extra call after them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.operators import scoring
from traceloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SEGMENT = ["user_id", "day"]
CLASSES = {"unit": [("single|one of", "each"), (r"by (\d+)", "by $1")]}


def _add(name: str, query: Callable, sql: str) -> None:
    QUERIES[name] = lambda spark, d: query(table(spark, d, "events"))
    ORACLES[name] = sql


def _calls(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Required and made calls."""
    first = F.min(F.struct("ts", "event_id")).over(Window.partitionBy("user_id", "day"))
    base = e.withColumn("day", F.to_date("ts")).withColumn("moved", (F.col("user_id") % 4 == 0) & (F.struct("ts", "event_id") == first))
    n, plain = F.col("event_id"), F.col("user_id") % 4 == 0
    at, k = F.concat(F.lit('{"at": '), n, F.lit(', "k": ')), F.get_json_object("props", "$.k")
    unit = F.when(n % 5 == 0, ', "unit": "single"}').otherwise(', "unit": "each"}')
    faulty = F.when(plain, F.concat(at, k, unit)).when(n % 13 == 0, "{at").when(n % 7 == 0, F.concat(at, F.lit('"x"'), unit)).otherwise(F.concat(at, k, F.lit(".0"), unit))

    def calls(df: DataFrame, last, second: int, tool, args) -> DataFrame:
        pos = F.struct(last.alias("last"), "ts", "event_id", F.lit(second).alias("second"))
        return df.select(*SEGMENT, pos.alias("pos"), F.hour("ts").alias("round"), tool.alias("tool"), args.alias("args"))

    required = calls(base, F.lit(0), 0, F.col("event_type"), F.concat(at, k, F.lit(', "unit": "each"}')))
    kept = calls(base.where(plain | (n % 11 != 0)), F.col("moved").cast("int"), 0, F.col("event_type"), faulty)
    extra = calls(base.where(~plain & (n % 17 == 0)), F.lit(0), 1, F.lit("noop"), F.lit("{}"))
    return required, kept.union(extra)


def _compared(e: DataFrame) -> DataFrame:
    return scoring.compared(*_calls(e), SEGMENT, CLASSES)


def _scored(e: DataFrame) -> DataFrame:
    return scoring.scores_of(_compared(e), SEGMENT)


# A required call is paired unless it is left out, changed, unreadable or moved; see the module's text.
EXPECTED = """
WITH base AS (
  SELECT *, ts::DATE AS day, user_id % 4 = 0 AS plain, count(*) OVER (PARTITION BY user_id, ts::DATE) AS size, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS place FROM events),
kind AS (
  SELECT *, CASE WHEN plain THEN CASE WHEN place = 1 AND size > 1 THEN 'moved' ELSE 'right' END
                 WHEN event_id % 11 = 0 THEN 'left out' WHEN event_id % 13 = 0 THEN 'unreadable' WHEN event_id % 7 = 0 THEN 'changed' ELSE 'right' END AS kind FROM base),
open_ AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts, event_id) AS r FROM kind WHERE kind <> 'right'),
unused AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts, event_id) AS r FROM kind WHERE kind IN ('changed', 'unreadable', 'moved')),
details AS (
  SELECT user_id, day, event_type AS tool, event_id AS required, event_id AS made, 'correct' AS reason FROM kind WHERE kind = 'right'
  UNION ALL
  SELECT o.user_id, o.day, o.event_type, o.event_id, u.event_id, CASE WHEN u.event_id IS NULL THEN 'missing' WHEN u.kind = 'unreadable' THEN 'unparseable_args'
           WHEN u.event_id <> o.event_id THEN 'wrong_args:at' WHEN u.kind = 'moved' THEN 'out_of_order' ELSE 'wrong_args:k' END
  FROM open_ o LEFT JOIN unused u ON o.user_id = u.user_id AND o.day = u.day AND o.event_type = u.event_type AND o.r = u.r
  UNION ALL SELECT user_id, day, 'noop', NULL, event_id, 'extra_call' FROM base WHERE NOT plain AND event_id % 17 = 0),
segments AS (
  SELECT user_id, day, count(required) AS required, count(*) FILTER (reason = 'correct') AS correct, count(*) FILTER (reason = 'extra_call') AS extra, bool_and(reason = 'correct') AS structure
  FROM details GROUP BY 1, 2)"""

_add("call_details", lambda e: scoring.details_of(_compared(e), SEGMENT).select("user_id", F.col("required_pos.event_id").alias("required_event"), F.col("made_pos.event_id").alias("made_event"), "tool", "reason"),
     EXPECTED + " SELECT user_id, required AS required_event, made AS made_event, tool, reason FROM details")

_add("segment_scores", _scored, EXPECTED + " SELECT * FROM segments")


def _tasks(e: DataFrame) -> DataFrame:
    """A user's calls are a task."""
    latency = F.when(F.col("user_id") % 10 != 3, F.max("value"))
    return e.groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "purchase").alias("complete"), F.when(F.col("user_id") % 9 == 0, "timeout").alias("error"), F.round(F.sum(F.round(F.col("value") * 100).cast("long")) / 1e5, 9).alias("cost"),
        latency.alias("latency"), F.count("*").alias("tokens_in"), F.count_if(F.col("event_type") == "view").alias("tokens_out"))


TASKS = EXPECTED + """,
tasks AS (
  SELECT user_id, bool_or(event_type = 'purchase') AS complete, CASE WHEN user_id % 9 = 0 THEN 'timeout' END AS error, round(sum(round(value * 100)::BIGINT) / 1e5::DOUBLE, 9) AS cost,
         CASE WHEN user_id % 10 <> 3 THEN max(value) END AS latency, count(*) AS tokens_in, count(*) FILTER (event_type = 'view') AS tokens_out FROM events GROUP BY 1),
scores AS (
  SELECT t.*, s.required, s.correct, s.extra, whole AND complete AND error IS NULL AS matched
  FROM tasks t JOIN (SELECT user_id, sum(required)::BIGINT AS required, sum(correct)::BIGINT AS correct, sum(extra)::BIGINT AS extra, bool_and(structure) AS whole FROM segments GROUP BY 1) s USING (user_id))"""

_add("task_scores", lambda e: scoring.task_scores(_scored(e), _tasks(e), "user_id"), TASKS + " SELECT * FROM scores")

_add("score_summary", lambda e: scoring.summary(scoring.task_scores(_scored(e), _tasks(e), "user_id"), {"route": F.col("user_id") % 4, "outcome": F.coalesce("error", F.lit("none"))}, "user_id").withColumn("cost", F.round("cost", 4)).withColumn("cost_a_task", F.round("cost_a_task", 4)), TASKS + """,
long AS (
  SELECT 'overall' AS slice, 'all' AS value, * FROM scores UNION ALL SELECT 'route', (user_id % 4)::VARCHAR, * FROM scores UNION ALL SELECT 'outcome', coalesce(error, 'none'), * FROM scores)
SELECT slice, value, count(*) AS n, round(avg(matched::INT), 4) AS trace_match, CASE WHEN sum(required) > 0 THEN round(sum(correct) / sum(required), 4) ELSE 1.0 END::DOUBLE AS call_match, sum(required)::BIGINT AS required,
       sum(correct)::BIGINT AS correct, sum(extra)::BIGINT AS extra, count(error) AS errors, count(latency) AS latencies, sum(tokens_in)::BIGINT AS tokens_in, sum(tokens_out)::BIGINT AS tokens_out,
       round(sum(cost), 4) AS cost, round(sum(cost) / count(*), 4) AS cost_a_task, min(user_id) AS least_task, max(user_id) AS most_task,
       round(quantile_disc(latency, 0.5), 1) AS p50, round(quantile_disc(latency, 0.95), 1) AS p95
FROM long GROUP BY 1, 2""")
