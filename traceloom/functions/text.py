"""Scalar rules over texts, dates and places, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_price(text: str, low: int = 30, high: int = 99999) -> Column:
    """Least whole number of a text within plausible prices; null without one."""
    return F.expr(f"array_min(filter(transform(regexp_extract_all({text}, '([0-9]{{2,6}})', 1), x -> cast(x AS int)), x -> x BETWEEN {low} AND {high}))")


def char_coverage(query: str, text: str) -> Column:
    """Share of the query's distinct characters that the text has."""
    q, t = (F.array_remove(F.array_distinct(F.split(F.lower(F.col(c)), "")), "") for c in (query, text))
    return F.size(F.array_intersect(q, t)) / F.size(q)


def squared_degrees(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Equirectangular kilometres at 111 a degree."""
    x, y = (lng2 - lng1) * F.cos(F.radians((lat1 + lat2) / 2)), lat2 - lat1
    return 111 * F.sqrt(x * x + y * y)


def date_forms(day: Column, today: Column) -> Column:
    """Ways to name a day: ISO, month-day, a relative word, this or next week."""
    ahead = F.date_diff(day, today)
    weeks = (F.date_diff(F.date_trunc("week", day).cast("date"), F.date_trunc("week", today).cast("date")) / 7).cast("int")
    return F.array_compact(F.array(
        F.date_format(day, "yyyy-MM-dd"),
        F.concat_ws("/", F.month(day).cast("string"), F.dayofmonth(day).cast("string")),
        F.when(ahead == 1, "tomorrow").when(ahead == 2, "in two days").when(ahead == 3, "in three days"),
        F.when(weeks == 0, "this week").when(weeks == 1, "next week"),
    ))


def rule_audit(docs: DataFrame) -> DataFrame:
    """PASS and FAIL counts of text rules, in long form."""
    rules = {
        "not_blank": F.trim("text") != "",
        "no_markup": ~F.col("text").contains("<"),
        "no_key": ~F.col("text").rlike("AKIA[A-Z0-9]{14,}"),
        "length_is_right": F.length("text") == F.col("n_chars"),
        "no_mail_address": ~F.col("text").rlike(r"[a-z0-9.]+@[a-z0-9]+\.[a-z]{2,}"),
    }
    wide = docs.select(*(F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()))
    pairs = ", ".join(f"'{n}', {n}" for n in rules)
    return wide.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, ok)")).groupBy("rule").agg(F.count_if("ok").alias("n_pass"), F.count_if(~F.col("ok")).alias("n_fail"))


def stem(name: Column, suffixes: tuple[str, ...]) -> Column:
    """Cut at each suffix in turn where its first occurrence leaves two characters or more."""
    for s in suffixes:
        at = F.instr(name, s)
        name = F.when(at > 2, F.substring(name, F.lit(1), at - 1)).otherwise(name)
    return name


def first_match(column: str, patterns: tuple[str, ...]) -> Column:
    """Group 1 of the first pattern that matches; null without one."""
    return F.coalesce(*(F.when(F.col(column).rlike(p), F.regexp_extract(column, p, 1)) for p in patterns))


def tier(column: str, needles: tuple[tuple[str, str], ...], default: str = "none") -> Column:
    """Label of the first needle that the text contains."""
    found = F.lit(default)
    for needle, label in reversed(needles):
        found = F.when(F.col(column).contains(needle), label).otherwise(found)
    return found


def without_block(column: str, tag: str) -> Column:
    """The text without its <tag>...</tag> blocks."""
    return F.regexp_replace(column, f"(?is)<{tag}>.*?</{tag}>", "")


def plain_form(column: str) -> Column:
    """Without white space, and without full stops and exclamation marks at the end."""
    return F.regexp_replace(F.regexp_replace(column, "[ \\t\\n\\r]+", ""), "[.!。！]+$", "")


def dialogue_act(column: str) -> Column:
    """invalid (blank), refusal, ask (has a question mark) or final."""
    t = F.coalesce(F.trim(column), F.lit(""))
    return F.when(t == "", "invalid").when(F.lower(t).rlike("cannot|unable|not able to"), "refusal").when(t.contains("?"), "ask").otherwise("final")


def meaningful(column: str, least: int = 12, distinct: int = 4) -> Column:
    """Whether a reply has enough characters besides spaces, and enough different ones."""
    t = F.replace(F.col(column), F.lit(" "), F.lit(""))
    return (F.length(t) >= least) & (F.size(F.array_distinct(F.split(t, ""))) >= distinct)


def fenced_json(column: str) -> Column:
    """The outermost braces of a reply, within a code fence or not; null without them."""
    return F.nullif(F.regexp_extract(column, r"(?s)(\{.*\})", 1), F.lit(""))


def gated_credit(correct: Column, required: Column, extra: Column, w_call: float = 0.8, w_clean: float = 0.2, w_extra: float = 0.1) -> Column:
    """Weighted share of required calls, a bonus if all are right and none is extra, less a penalty for extra ones, within 0 and 1.

    Where none is required silence gets full marks.
    """
    scored = w_call * correct / required + F.when((correct == required) & (extra == 0), w_clean).otherwise(0.0) - w_extra * extra
    return F.when(required == 0, F.when(extra == 0, 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scored)))
