"""Joins, filters, rankings, allocations and validators on records.

Nulls: an inner or anti join never matches a null key; filters drop rows whose
condition is null unless their docstring says otherwise. Empty tables give
empty results, repeated rows are each kept where no key makes them one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from traceloom.functions import scalar
from traceloom.operators.ranks import hash_ranks, running
from traceloom.session import small_side


def strip_if_known(rows: DataFrame, column: str, suffix: str, registry: DataFrame, key: str) -> DataFrame:
    """``column`` without a closing ``suffix`` where the rest is a key of the registry; other values stay."""
    known = small_side(registry.select(F.col(key).alias("known")).distinct())
    rest = F.when(F.col(column).endswith(suffix), F.expr(f"left({column}, length({column}) - {len(suffix)})"))
    joined = rows.withColumn("rest", rest).join(known, F.col("rest") == F.col("known"), "left")
    return joined.withColumn(column, F.coalesce("known", column)).drop("rest", "known")


def within_budget(rows: DataFrame, group: str, price: str, ceiling: float) -> DataFrame:
    """Of groups with any known price, rows without a price or at most the ceiling; of other groups all rows."""
    known = F.max(F.col(price)).over(Window.partitionBy(group)).isNotNull()
    return rows.withColumn("known", known).where(~F.col("known") | F.col(price).isNull() | (F.col(price) <= ceiling)).drop("known")


#: ASCII characters that are no part of a word; others, of any script, are kept.
GAPS = r"[\x00-\x22\x24-\x2F\x3A-\x5E\x60\x7B-\x7F]+"
WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_#")


def plain_words(c: Column) -> Column:
    """Lower case, with one space for every run of ASCII characters that are no part of a word."""
    return F.regexp_replace(F.lower(c), GAPS, " ")


def contained(rows: DataFrame, text: str, names: DataFrame, name: str, most: int = 200_000) -> DataFrame:
    """(row, name) pairs whose text holds the name, both as ``plain_words``.

    A name that begins or ends with an ASCII letter, digit, _ or # does not
    count inside a longer run of these; names of other scripts count anywhere,
    as their texts have no spaces. Names without any word, and null texts, are
    in no pair; a name is found once a row.

    Names go to the tasks as an automaton, at most ``most`` at once: a larger
    registry is dealt by hash and takes a pass over the rows for each deal.
    """
    import ahocorasick

    known = names.select(F.col(name).alias("name"), F.trim(plain_words(F.col(name))).alias("plain")).where("plain <> ''").distinct()
    n, schema = known.count(), StructType([*rows.schema.fields, StructField("name", StringType())])
    deals = -(-n // most)
    found = rows.where("false").withColumn("name", F.lit(None).cast("string"))
    for deal in range(deals):
        forms: dict[str, list[str]] = {}
        for r in known.where(F.pmod(F.xxhash64("plain"), F.lit(deals)) == deal).collect():  # bounded by most
            forms.setdefault(r.plain, []).append(r.name)
        shared = rows.sparkSession.sparkContext.broadcast(forms)

        def run(batches, shared=shared):
            tree = ahocorasick.Automaton()
            for plain, of in shared.value.items():
                tree.add_word(plain, (plain, of))
            tree.make_automaton()
            for b in batches:
                at, hits = [], []
                for i, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
                    t, seen = f" {t or ''} ", set()
                    for end, (plain, of) in tree.iter(t):
                        inside = (plain[0] in WORD and t[end - len(plain)] in WORD) or (plain[-1] in WORD and t[end + 1] in WORD)
                        if plain not in seen and not inside:
                            seen.add(plain)
                            at += [i] * len(of)
                            hits += of
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(at, pa.int64())).columns[:-1], pa.array(hits, pa.string())], schema.names)

        found = found.union(rows.withColumn("__plain", plain_words(F.col(text))).where("__plain IS NOT NULL").mapInArrow(run, schema))
    return found


def nearest(points: DataFrame, places: DataFrame, radius: float, step: float = 1.0) -> DataFrame:
    """Of each point (id, lat, lon) the nearest place (place, plat, plon) within ``radius`` km, ties by place; points without one are left out.

    Places are copied to the grid cells around them, so points meet near places
    alone. The cell is at least as wide as the radius at the equator.
    """
    size = max(step, radius / 85.0)
    cell = lambda c: F.floor(F.col(c) / size)
    around = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
    near = places.withColumn("dx", around).withColumn("dy", around).select("place", "plat", "plon", (cell("plat") + F.col("dx")).alias("cx"), (cell("plon") + F.col("dy")).alias("cy"))
    met = points.withColumn("cx", cell("lat")).withColumn("cy", cell("lon")).join(near, ["cx", "cy"])
    met = met.withColumn("km", F.round(scalar.fixed_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")), 6)).where(F.col("km") <= radius)
    return met.groupBy("id").agg(F.min(F.struct("km", "place")).alias("best")).select("id", "best.place", "best.km")


def quotas(routes: DataFrame, group: str, budget: str, ok_share: float = 0.8) -> DataFrame:
    """(group, route, share): each group's budget dealt to its routes.

    ``routes`` has (group, route, fails, budget), one row a route. Where a group
    has both kinds, the routes that do not fail get ``ok_share`` of the budget,
    rounded half to even, and those that fail the rest, rounded likewise; a
    kind's budget is divided evenly, the remainder going to its first routes. What
    rounding leaves goes to the group's largest share.
    """
    of_group, of_kind = Window.partitionBy(group), Window.partitionBy(group, "fails")
    mixed = F.count_if("fails").over(of_group).between(1, F.count("*").over(of_group) - 1)
    part = F.when(F.col("fails"), 1 - ok_share).otherwise(ok_share)
    kind = F.when(mixed, F.bround(F.col(budget) * part, 0)).otherwise(F.col(budget)).cast("long")
    size = F.count("*").over(of_kind)
    extra = F.when(F.row_number().over(of_kind.orderBy("route")) <= F.pmod("kind", size), 1).otherwise(0)
    dealt = routes.withColumn("kind", kind).withColumn("share", (F.floor(F.col("kind") / size) + extra).cast("long"))
    drift = F.col(budget) - F.sum("share").over(of_group)
    most = F.row_number().over(of_group.orderBy(F.desc("share"), "route")) == 1
    return dealt.withColumn("drift", drift).select(group, "route", (F.col("share") + F.when(most, F.col("drift")).otherwise(0)).cast("long").alias("share"))


def largest_remainder(counts: DataFrame, key: str, n: str, target: int, floor: int = 0) -> DataFrame:
    """(key, share): ``target`` places dealt to the keys, by largest remainder, ties by key, never more than ``n``.

    Each key first gets ``floor`` places, which may exceed the target; the rest
    is dealt in proportion to ``n``. ``counts`` is one row a key: its window is
    over a catalogue of routes, not over data.
    """
    every = Window.partitionBy(F.lit(0))
    first = counts.withColumn("first", F.least(F.lit(floor), F.col(n))).withColumn("total", F.sum(n).over(every))
    left = first.withColumn("left", F.greatest(F.lit(0), F.lit(target) - F.sum("first").over(every)))
    parts = left.withColumn("whole", F.floor(F.col(n) * F.col("left") / F.col("total"))).withColumn("rest", F.pmod(F.col(n) * F.col("left"), F.col("total")))
    ranked = parts.withColumn("over", F.col("left") - F.sum("whole").over(every)).withColumn("rank", F.row_number().over(every.orderBy(F.desc("rest"), key)))
    share = F.col("first") + F.col("whole") + F.when(F.col("rank") <= F.col("over"), 1).otherwise(0)
    return ranked.select(key, F.least(share, F.col(n)).cast("long").alias("share"))


def anchors(rows: DataFrame, key: str, ident: str, shares: DataFrame, salt: str = "anchor") -> DataFrame:
    """Of each key as many rows as its share, least by a salted SHA-256 of the identifier; a large key is ranked in many cells."""
    hashed = rows.select(key, ident, F.sha2(F.concat(F.lit(salt + ":"), F.col(ident).cast("string")), 256).alias("__hash"))
    return hash_ranks(hashed, key, "__hash").join(small_side(shares), key).where(F.col("rank") <= F.col("share")).select(key, ident)


def roll_up(scores: DataFrame) -> DataFrame:
    """One row over (required, correct, extra, matched, latency): rates to four places, 1.0 where nothing is required.

    Latencies are nearest ranks, counted along ranges of them; equal ones are
    counted before, so that many of one value make one row.
    """
    rate = F.when(F.sum("required") > 0, F.round(F.sum("correct") / F.sum("required"), 4)).otherwise(1.0)
    sums = scores.agg(
        F.count("*").alias("n"), F.coalesce(F.round(F.avg(F.col("matched").cast("int")), 4), F.lit(0.0)).alias("trace_match"), F.coalesce(rate, F.lit(1.0)).alias("toolcall_match"),
        F.sum("required").cast("long").alias("required"), F.sum("correct").cast("long").alias("correct"), F.sum("extra").cast("long").alias("extra"))
    of = scores.where("latency IS NOT NULL").groupBy("latency").agg(F.count("*").alias("k"))
    along = running(of, [], ["latency"], "k")
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("latency")))
    return sums.crossJoin(along.agg(at(0.5).alias("p50"), at(0.95).alias("p95")))  # one row each


def first_result(calls: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """A single-flight cache: one execution a key, the first value in order, and how many callers it served."""
    return calls.groupBy(*key).agg(F.min_by(value, F.struct(*order)).alias(value), F.count("*").alias("served"))


def retry_stage(attempts: DataFrame, key: str, turn: str, ok: Column, k: int) -> DataFrame:
    """The attempts that count: the first ``k`` of a key and, only where all of these fail, the next ``k``."""
    ranked = attempts.withColumn("ok", ok).withColumn("try", F.row_number().over(Window.partitionBy(key).orderBy(turn)))
    early = F.max(F.when(F.col("try") <= k, F.col("ok").cast("int"))).over(Window.partitionBy(key))
    return ranked.withColumn("early", early).where((F.col("try") <= k) | ((F.col("early") == 0) & (F.col("try") <= 2 * k))).drop("early")


def gate(calls: DataFrame, key: str, turn: str, ok: Column, needs: Column) -> DataFrame:
    """``skipped``: whether a call that needs an earlier one of its round follows no successful one."""
    before = Window.partitionBy(key).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.max(ok.cast("int")).over(before), F.lit(0))
    return calls.withColumn("skipped", needs & (done == 0))


def quarantine(runs: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Every run with ``status`` accepted or quarantined and the first rule that it breaks."""
    broken = F.coalesce(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()])
    return runs.withColumn("broken", broken).withColumn("status", F.when(F.col("broken").isNull(), "accepted").otherwise("quarantined"))


def rule_table(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule, status) in long form, one row a record and rule. A condition that is null fails."""
    checks = F.array(*[F.struct(F.lit(name).alias("rule"), F.when(F.coalesce(c, F.lit(False)), "PASS").otherwise("FAIL").alias("status")) for name, c in rules.items()])
    return rows.select(key, F.explode(checks).alias("c")).select(key, "c.rule", "c.status")


def pending(every: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Keys of a resumable run with their state: done once any attempt succeeded, failed, or pending without one."""
    state = log.groupBy(key).agg(F.max(F.col("ok").cast("int")).alias("best"))
    state = every.select(key).distinct().join(state, key, "left")
    return state.select(key, F.when(F.col("best") == 1, "done").when(F.col("best") == 0, "failed").otherwise("pending").alias("state"))


def complete_partition(parts: DataFrame, part: str, whole: DataFrame, key: str) -> DataFrame:
    """(problem, key): keys in no part, in several, or in a part but not in the whole. No rows: the parts partition the whole."""
    seen = parts.groupBy(key).agg(F.count_distinct(part).alias("parts"))
    both = whole.select(key).distinct().withColumn("known", F.lit(1)).join(seen, key, "full")
    problem = F.when(F.col("parts").isNull(), "missing").when(F.col("known").isNull(), "unknown").when(F.col("parts") > 1, "in several")
    return both.select(problem.alias("problem"), key).where("problem IS NOT NULL")


def flatten_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, flat): role-tagged texts of a conversation in order of turn, a line each; null texts are empty."""
    line = F.concat(F.lit("["), F.col("role"), F.lit("] "), F.coalesce("text", F.lit("")))
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("t"))
    return turns.select("conv_id", F.array_join("t.line", "\n").alias("flat"))


def response_mask(messages: DataFrame, most: int) -> DataFrame:
    """(conv_id, mask): per word of a conversation 1 if the assistant wrote it and 0 otherwise, cut to ``most`` words."""
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != ""))
    bits = F.repeat(F.when(F.col("role") == "assistant", "1").otherwise("0"), n)
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", bits.alias("bits")))).alias("t"))
    return turns.select("conv_id", F.left(F.array_join("t.bits", ""), F.lit(most)).alias("mask"))


def same_trace(events: DataFrame, plan: tuple[str, ...]) -> DataFrame:
    """Users whose calls of their first day equal the plan, in order and in full, and all others."""
    day = F.to_date("ts")
    first = events.withColumn("first", F.min(day).over(Window.partitionBy("user_id"))).where(day == F.col("first"))
    made = first.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda x: x["event_type"]).alias("made"))
    return made.select("user_id", F.size("made").cast("long").alias("n"), (F.col("made") == F.array(*map(F.lit, plan))).alias("same"))
