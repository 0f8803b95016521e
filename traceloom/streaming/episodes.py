"""Episodes: a state machine per key over ordered actions, in batch and as a stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (state, action): next state. Any other action is a violation and changes nothing.
MOVES = {("new", "view"): "seen", ("new", "signup"): "seen", ("seen", "view"): "seen", ("seen", "click"): "engaged", ("engaged", "click"): "engaged", ("engaged", "view"): "seen", ("engaged", "purchase"): "done"}
STEP_CAP = 24


def advance(state: str, action: str) -> tuple[str, bool]:
    to = MOVES.get((state, action))
    return (to, True) if to else (state, False)


def replay(events: DataFrame) -> DataFrame:
    """Final state, violations and steps of each user's events in order, cut off at the step cap or at the end state.

    Every event is a step, so those beyond the cap never count and only so many of a user are gathered.
    """
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = events.withColumn("step", F.row_number().over(order)).where(F.col("step") <= STEP_CAP)
    moved = "CASE " + " ".join(f"WHEN s.state = '{a}' AND x.event_type = '{b}' THEN '{c}'" for (a, b), c in MOVES.items()) + " END"
    steps = F.expr(
        "aggregate(array_sort(collect_list(struct(ts, event_id, event_type))), named_struct('state', 'new', 'bad', 0, 'n', 0), (s, x) -> "
        f"CASE WHEN s.n >= {STEP_CAP} OR s.state = 'done' THEN s ELSE named_struct('state', coalesce({moved}, s.state), 'bad', s.bad + CASE WHEN ({moved}) IS NULL THEN 1 ELSE 0 END, 'n', s.n + 1) END)"
    )
    return events.groupBy("user_id").agg(steps.alias("s")).select("user_id", "s.state", F.col("s.bad").alias("violations"), F.col("s.n").alias("steps"))


def stream_replay(events: DataFrame) -> DataFrame:
    """The same machine over a stream: one row per user and batch with its state so far. Each batch is taken in order of time."""

    def step(key, frames, state):
        at, bad, n = state.get if state.exists else ("new", 0, 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for action in rows["event_type"]:
            if n >= STEP_CAP or at == "done":
                break
            at, ok = advance(at, action)
            bad, n = bad + (not ok), n + 1
        state.update((at, bad, n))
        yield pd.DataFrame({"user_id": [key[0]], "state": [at], "violations": [bad], "steps": [n]})

    schema = "user_id long, state string, violations int, steps int"
    return events.groupBy("user_id").applyInPandasWithState(step, schema, "state string, violations int, steps int", "update", "NoTimeout")


def session_rollup(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user by a gap in time; the watermark bounds state when the input is a stream."""
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"), F.max("value").alias("top")).select("user_id", F.col("session_window.start").alias("started"), "n", "top")
