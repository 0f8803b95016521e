"""A table of text rules held against conversations, and the ways in which a date is said."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days of the week from Monday, words for days to come, and marks of this and the next week.
WEEKDAYS = "一二三四五六日"
AHEAD = {1: "明天", 2: "后天", 3: "大后天"}
THIS_WEEK, NEXT_WEEK = ("这", "本", ""), ("下",)
SCOPES = ("any", "user", "assistant", "first user", "last assistant")
KINDS = ("must", "must not", "names date", "hides date", "weekday window", "relative date")


def weekday_word(day: Column) -> Column:
    return F.concat(F.lit("周"), F.substr(F.lit(WEEKDAYS), F.weekday(day) + 1, F.lit(1)))


def date_words(day: Column, today: Column) -> Column:
    """Array of the ways to say ``day`` on ``today``: month and day, ISO, a word for the next three days, weekdays of this and the next week, which begin on Monday."""
    ahead, word = F.date_diff(day, today), weekday_word(day)
    weeks = F.date_diff(F.trunc(day, "week"), F.trunc(today, "week"))
    month = F.concat(F.month(day), F.lit("月"), F.day(day))
    said = [F.concat(month, F.lit("日")), F.concat(month, F.lit("号")), F.date_format(day, "yyyy-MM-dd"), *(F.when(ahead == n, w) for n, w in AHEAD.items())]
    said += [F.when(weeks == n, F.concat(F.lit(mark), word)) for n, marks in ((0, THIS_WEEK), (7, NEXT_WEEK)) for mark in marks]
    return F.filter(F.array(*said), lambda x: x.isNotNull())


def _applies(scope: str) -> Column:
    role = F.col("role")
    return {"any": F.lit(True), "user": role == "user", "assistant": role == "assistant", "first user": (role == "user") & F.col("opens"), "last assistant": (role == "assistant") & F.col("closes")}[scope]


def _broken(kind: str, pattern: str, facts: list[str]) -> tuple[Column, list[str]]:
    """Whether a text breaks the rule, and the facts that it needs."""
    text, words = F.col("text"), F.col("date_words")
    names = F.exists(words, lambda w: text.contains(w))
    found = F.regexp_extract_all(text, F.lit(f"周([{WEEKDAYS}])(?![边围])"), F.lit(0))
    if kind in ("names date", "hides date"):
        return (~names if kind == "names date" else names), ["day", "today"]
    if kind == "weekday window":  # weekdays that none of the stay's days is
        inside = F.transform(F.sequence(F.lit(0), F.col("days").cast("int") - 1), lambda i: weekday_word(F.date_add("day", i)))
        return F.size(F.array_except(found, inside)) > 0, ["day", "days"]
    if kind == "relative date":  # the day's own weekday, said to be in another week
        told = F.regexp_extract_all(text, F.lit(f"([这本下])周[{WEEKDAYS}]"), F.lit(0))
        return F.exists(told, lambda m: (F.right(m, F.lit(2)) == weekday_word(F.col("day"))) & ~F.array_contains(words, m)), ["day", "today"]
    held = [f for f in re.findall(r"\{(\w+)\}", pattern) if f in facts]
    parts = re.split("|".join(r"\{" + f + r"\}" for f in held), pattern) if held else [pattern]
    quoted = [F.concat(F.lit(r"\Q"), F.replace(F.col(f).cast("string"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")) for f in held]
    whole = F.concat(*[x for i, p in enumerate(parts) for x in (F.lit(p), *quoted[i : i + 1])])
    hit = F.regexp_like(text, whole)
    return (~hit if kind == "must" else hit), held


def audit(messages: DataFrame, facts: DataFrame, rules: DataFrame, most: int = 10_000) -> DataFrame:
    """(conv_id, rule, status, n, turn): PASS or FAIL of every rule that looks at a conversation, over ``n`` messages, and the first turn that fails.

    ``rules`` are (rule, scope, kind, pattern), a table of at most ``most`` rows,
    compiled once. Scopes: any, user, assistant, first user, last assistant.
    Kinds: ``must`` and ``must not`` match the pattern, in which {column} stands
    for a fact's value, literally; ``names date`` and ``hides date``, any of
    ``date_words``; ``weekday window``, no weekday outside the facts' ``days``
    from ``day``; ``relative date``, the day's weekday only with the right week.
    ``facts`` has one row a conversation: conv_id, day, today, days and more. A
    rule with a fact that is null, or a conversation without facts, does not
    apply. Null texts are empty.
    """
    table = rules.select("rule", "scope", "kind", F.coalesce("pattern", F.lit("")).alias("pattern")).limit(most + 1).collect()
    if len(table) > most or len({r.rule for r in table}) < len(table):
        raise ValueError("too many rules, or a name twice")
    if bad := [r.rule for r in table if r.scope not in SCOPES or r.kind not in KINDS]:
        raise ValueError(f"no such scope or kind: {bad}")
    of = Window.partitionBy("conv_id", "role")
    own = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("opens", F.col("turn") == F.min("turn").over(of)).withColumn("closes", F.col("turn") == F.max("turn").over(of))
    named = [c for c in facts.columns if c != "conv_id"]
    own = own.join(facts, "conv_id", "left").withColumn("date_words", date_words(F.col("day"), F.col("today")))
    looks = []
    for r in table:
        broken, needs = _broken(r.kind, r.pattern, named)
        known = _applies(r.scope)
        for fact in needs:
            known = known & F.col(fact).isNotNull()
        looks.append(F.when(known, F.struct(F.lit(r.rule).alias("rule"), broken.alias("broken"))))
    seen = own.select("conv_id", "turn", F.explode(F.filter(F.array(*looks), lambda x: x.isNotNull())).alias("x"))
    of_rule = seen.groupBy("conv_id", "x.rule").agg(F.count("*").alias("n"), F.min(F.when(F.col("x.broken"), F.col("turn"))).alias("turn"))
    return of_rule.select("conv_id", "rule", F.when(F.col("turn").isNull(), "PASS").otherwise("FAIL").alias("status"), "n", "turn")
