"""Episodes with three caps and slots that persons reveal: over a table by windows, and over a stream with timers.

Actions are (episode, ts, seq, kind, slot), taken in order of (ts, seq):
``person``, a reply that reveals its slot and begins a turn; rounds of the
assistant: ``ask``, wrong for a slot that is known, ``tool``, wrong for one that
is not, and ``final``, which ends the episode if its slot is known or null and
is wrong otherwise; any other kind is a wrong round. After each action the caps
are looked at in the order of ``CAPS``; the first that is reached cuts the
episode off, which counts as one more wrong. What follows an end changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# The caps on all rounds, on the rounds of a person's turn and on such turns.
CAPS = {"max_assistant_rounds": 24, "max_rounds_per_user_turn": 6, "max_person_turns": 8}
ENDED = "episode string, outcome string, rounds int, turns int, violations int, slots string, reward double"


def reward(outcome, violations):
    """Column of the reward: nothing for a cut off episode, else 1.5 less 0.2 a violation, 0.5 at least."""
    return F.when(outcome == "done", F.greatest(F.lit(0.5), F.round(1.5 - 0.2 * violations, 6))).otherwise(0.0)


def ended(actions: DataFrame, caps: dict[str, int] = CAPS) -> DataFrame:
    """ENDED: of each episode that came to an end its outcome, ``done`` or the cap's name, and what it had come to.

    Windows over an episode alone; a slot is known from the first reply that
    revealed it. Rows without an episode are left out. Equal (ts, seq) have no
    order.
    """
    along = Window.partitionBy("episode").orderBy("ts", "seq")
    upto, before = (w.rowsBetween(Window.unboundedPreceding, n) for w, n in ((along, 0), (Window.partitionBy("episode", "slot").orderBy("ts", "seq"), -1)))
    person = F.coalesce(F.col("kind") == "person", F.lit(False))
    s = actions.where("episode IS NOT NULL").withColumn("person", person.cast("int"))
    s = s.withColumn("turns", F.sum("person").over(upto)).withColumn("rounds", F.sum(1 - F.col("person")).over(upto)).withColumn("pos", F.row_number().over(along))
    s = s.withColumn("in_turn", F.sum(1 - F.col("person")).over(Window.partitionBy("episode", "turns").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("known", F.col("slot").isNotNull() & (F.coalesce(F.max("person").over(before), F.lit(0)) == 1))
    fine = F.when(F.col("person") == 1, True).when(F.col("kind") == "ask", ~F.col("known")).when(F.col("kind") == "tool", F.col("known")).when(F.col("kind") == "final", F.col("known") | F.col("slot").isNull())
    s = s.withColumn("wrong", (~F.coalesce(fine, F.lit(False))).cast("int"))
    done = F.coalesce(F.col("kind") == "final", F.lit(False)) & (F.col("wrong") == 0)
    names = list(caps)
    cap = F.when(F.col("rounds") >= caps[names[0]], names[0]).when(F.col("in_turn") >= caps[names[1]], names[1]).when(F.col("turns") >= caps[names[2]], names[2])
    s = s.withColumn("outcome", F.when(done, "done").otherwise(cap)).withColumn("stop", F.min(F.when(F.col("outcome").isNotNull(), F.col("pos"))).over(Window.partitionBy("episode")))
    last = F.struct("pos", "outcome", "rounds", "turns")
    end = s.where("pos <= stop").groupBy("episode").agg(F.max(last).alias("at"), F.sum("wrong").alias("wrong"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("person") == 1, F.col("slot")))), ",").alias("slots"))
    violations = F.col("wrong") + F.when(F.col("at.outcome") == "done", 0).otherwise(1)
    return end.select("episode", "at.outcome", F.col("at.rounds").cast("int").alias("rounds"), F.col("at.turns").cast("int").alias("turns"), violations.cast("int").alias("violations"), "slots", reward(F.col("at.outcome"), violations).alias("reward"))


class Episode(StatefulProcessor):
    """Holds actions until the watermark has passed them, then takes them in order; an end is told once.

    An action that comes after the watermark passed its time is late and left
    out, for what follows it has been taken already.
    """

    def __init__(self, caps: dict[str, int]):
        self.caps = list(caps.items())

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, seq long, kind string, slot string")
        self.now = handle.getValueState("now", "rounds int, in_turn int, turns int, wrong int, slots array<string>, over boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        over = self.now.exists() and self.now.get()[5]
        for frame in rows:
            for at, seq, kind, slot in zip(frame["ts"].astype("datetime64[us]").astype("int64"), frame["seq"], frame["kind"], frame["slot"]):
                if not over and at // 1000 > mark:
                    self.waiting.appendValue((int(at), int(seq), kind, slot if isinstance(slot, str) else None))
                    self.handle.registerTimer(int(at // 1000) + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        held = list(self.waiting.get())
        rounds, in_turn, turns, wrong, slots, over = self.now.get() if self.now.exists() else (0, 0, 0, 0, [], False)
        ready, slots, outcome = sorted(((a, s, k, x) for a, s, k, x in held if a // 1000 < due), key=lambda r: r[:2]), list(slots), None
        for _, _, kind, slot in ready if not over else ():
            if kind == "person":
                turns, in_turn = turns + 1, 0
                slots += [slot] if slot is not None and slot not in slots else []
            else:
                rounds, in_turn, known = rounds + 1, in_turn + 1, slot in slots
                fine = {"ask": not known, "tool": known, "final": known or slot is None}.get(kind, False)
                wrong += not fine
                outcome = "done" if kind == "final" and fine else None
            reached = (name for (name, most), n in zip(self.caps, (rounds, in_turn, turns)) if n >= most)
            outcome = outcome or next(reached, None)
            if outcome:
                over = True
                break
        self.now.update((rounds, in_turn, turns, wrong, slots, over))
        rest = [(a, s, k, x) for a, s, k, x in held if a // 1000 >= due] if not over else []
        self.waiting.clear()
        for r in rest:
            self.waiting.appendValue(tuple(r))
        if outcome:
            bad = wrong + (outcome != "done")
            gain = max(0.5, round(1.5 - 0.2 * bad, 6)) if outcome == "done" else 0.0
            yield pd.DataFrame({"episode": [key[0]], "outcome": [outcome], "rounds": [rounds], "turns": [turns], "violations": [bad], "slots": [",".join(sorted(slots))], "reward": [gain]})
        else:
            yield pd.DataFrame()

    def close(self) -> None:
        pass


def keep_in_rocksdb(spark: SparkSession) -> None:
    """State with lists and timers needs this store; call it before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_ended(actions: DataFrame, late: str = "1 hour", caps: dict[str, int] = CAPS) -> DataFrame:
    """As ``ended``, over a stream in append mode: rows may come in any order within ``late``; later ones are left out.

    An episode's end is told once the watermark has passed it.
    """
    kept = actions.where("episode IS NOT NULL").select("episode", "ts", F.col("seq").cast("long").alias("seq"), "kind", "slot").withWatermark("ts", late)
    return kept.groupBy("episode").transformWithStateInPandas(Episode(caps), ENDED, "Append", "EventTime")
