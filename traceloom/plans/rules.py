"""Queries of text rules over whole conversations and of replies, with their SQL.

The first user text of a conversation gets a date phrase put in by rule, right
for some conversations and wrong for others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions import dialogue
from traceloom.operators import text_rules
from traceloom.session import table

RULES = [
    ("no_json", "any", "must not", r'[{}\[\]"]{2}'), ("no_control_strings", "any", "must not", r"</?s>|\[/?INST\]|<\|"), ("user_says_something", "user", "must", r"\S"), ("assistant_says_something", "assistant", "must", r"\S"),
    ("assistant_ends_a_sentence", "assistant", "must", r"[.!?]\s*\z"), ("user_begins_large", "user", "must", r"^\p{Lu}"), ("user_without_digits", "user", "must not", r"[0-9]"), ("user_is_short", "user", "must not", r"(?s)^.{400}"),
    ("assistant_has_lines", "assistant", "must", r"\n"), ("single_spaces", "any", "must not", "  "), ("opening_is_whole", "first user", "must", r"^([^ \n]+[ \n]+){5}"), ("opening_without_question", "first user", "must not", r"\?"),
    ("last_ends", "last assistant", "must", r"\.\s*\z"), ("last_is_no_list", "last assistant", "must not", r"(^|\n)[-*]"), ("last_is_long", "last assistant", "must", r"(?s)^.{200}"), ("in_german", "assistant", "must", r"(^|[^a-zäöü])(der|die|das|und)[^a-zäöü]"),
    ("not_in_french", "any", "must not", r"(^|[^a-zéèêç])(le|la|les|des)[^a-zéèêç]"), ("city_is_kept", "last assistant", "must", "{city}"), ("city_is_no_origin", "user", "must not", "(from|aus|de) {city}"), ("nothing_forbidden", "any", "must not", "(?i)lorem|ipsum"),
    ("date_is_told", "first user", "names date", ""), ("date_is_hidden", "assistant", "hides date", ""), ("weekdays_in_window", "first user", "weekday window", ""), ("week_is_right", "first user", "relative date", ""),
]


def _messages(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = c.where("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("first"), F.min_by("text", "turn").alias("opening"))
    n = F.col("conv_id")
    word = F.element_at(F.split("opening", r"[ \n.,!?]+"), 1)
    facts = first.select(
        "conv_id", "first", F.date_add(F.lit("2024-01-04").cast("date"), (n % 17).cast("int")).alias("day"), F.date_add(F.lit("2024-01-01").cast("date"), (n % 9).cast("int")).alias("today"), (n % 3 + 1).alias("days"),
        F.when((n % 10 != 0) & (word != ""), word).alias("city"))
    day = F.col("day")
    said = (
        F.when(n % 6 == 0, F.date_format("day", "yyyy-MM-dd")).when(n % 6 == 1, F.concat(F.month(day), F.lit("月"), F.day(day), F.lit("号"))).when(n % 6 == 2, text_rules.weekday_word(day))
        .when(n % 6 == 3, "").when(n % 6 == 4, F.concat(F.lit("下"), text_rules.weekday_word(day))).otherwise("明天 周三"))
    told = c.join(facts, "conv_id", "left").withColumn("text", F.when((F.col("role") == "user") & (F.col("turn") == F.col("first")), F.concat("text", F.lit(" "), said)).otherwise(F.col("text")))
    return told.select("conv_id", "turn", "role", "text"), facts.drop("first")


def _audit(spark: SparkSession, d: str) -> DataFrame:
    messages, facts = _messages(table(spark, d, "conversations"))
    return text_rules.audit(messages, facts, spark.createDataFrame(RULES, "rule string, scope string, kind string, pattern string"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"text_rules": _audit}


def _sql() -> str:
    scope = {"any": "true", "user": "role = 'user'", "assistant": "role = 'assistant'", "first user": "role = 'user' AND opens", "last assistant": "role = 'assistant' AND closes"}
    names = "len(list_filter(words, lambda x: contains(text, x))) > 0"
    date = {
        "names date": f"NOT ({names})", "hides date": names, "weekday window": "len(list_filter(regexp_extract_all(text, '周[一二三四五六日]'), lambda x: NOT list_contains(inside, x))) > 0",
        "relative date": "len(list_filter(regexp_extract_all(text, '[这本下]周[一二三四五六日]'), lambda x: right(x, 2) = wd AND NOT list_contains(words, x))) > 0"}
    looks = []
    for rule, where, kind, pattern in RULES:
        known = "true"
        if kind in date:
            broken = date[kind]
        else:
            quoted = "'" + pattern.replace("'", "''") + "'"
            if "{city}" in pattern:
                quoted, known = quoted.replace("{city}", "' || regexp_replace(city, '([\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E])', '\\\\\\1', 'g') || '"), "city IS NOT NULL"
            hit = f"regexp_matches(text, {quoted})"
            broken = f"NOT {hit}" if kind == "must" else hit
        looks.append(f"SELECT conv_id, turn, '{rule}' AS rule, {broken} AS broken FROM m WHERE {scope[where]} AND {known}")
    return f"""
WITH f AS (
  SELECT conv_id, min(turn) AS first, arg_min(text, turn) AS opening, DATE '2024-01-04' + (conv_id % 17)::INT AS day, DATE '2024-01-01' + (conv_id % 9)::INT AS today, conv_id % 3 + 1 AS days FROM conversations WHERE role = 'user' GROUP BY conv_id),
g AS (
  SELECT *, '周' || substr('一二三四五六日', isodow(day)::INT, 1) AS wd, CASE WHEN conv_id % 10 <> 0 THEN nullif(regexp_split_to_array(opening, '[ \\n.,!?]+')[1], '') END AS city,
         list_transform(range(days), lambda i: '周' || substr('一二三四五六日', isodow(day + i::INT)::INT, 1)) AS inside, date_diff('day', date_trunc('week', today), date_trunc('week', day)) AS weeks, day - today AS ahead FROM f),
h AS (
  SELECT *, list_filter([month(day) || '月' || day(day) || '日', month(day) || '月' || day(day) || '号', strftime(day, '%Y-%m-%d'), CASE ahead WHEN 1 THEN '明天' WHEN 2 THEN '后天' WHEN 3 THEN '大后天' END,
         CASE WHEN weeks = 0 THEN '这' || wd END, CASE WHEN weeks = 0 THEN '本' || wd END, CASE WHEN weeks = 0 THEN wd END, CASE WHEN weeks = 7 THEN '下' || wd END], lambda x: x IS NOT NULL) AS words FROM g),
m AS (
  SELECT c.conv_id, turn, role, turn = min(turn) OVER w AS opens, turn = max(turn) OVER w AS closes, words, wd, inside, city, CASE WHEN role = 'user' AND turn = first THEN c.text || ' ' || CASE c.conv_id % 6
           WHEN 0 THEN strftime(day, '%Y-%m-%d') WHEN 1 THEN month(day) || '月' || day(day) || '号' WHEN 2 THEN wd WHEN 3 THEN '' WHEN 4 THEN '下' || wd ELSE '明天 周三' END ELSE c.text END AS text
  FROM conversations c JOIN h USING (conv_id) WINDOW w AS (PARTITION BY c.conv_id, role)),
x AS ({" UNION ALL ".join(looks)})
SELECT conv_id, rule, CASE WHEN bool_or(broken) THEN 'FAIL' ELSE 'PASS' END AS status, count(*) AS n, min(turn) FILTER (broken) AS turn FROM x GROUP BY 1, 2"""


ORACLES: dict[str, str] = {"text_rules": _sql()}


#: Replies by turns, {n} for the event's number and {k} for its property.
REPLIES = (
    "请问您打算什么时候出发？", "您想了解哪家酒店呢？", "您想去哪里？", "导航路线的终点是哪里？", "抱歉，我是旅行助手，只能回答旅行相关的问题。", "为您安排上海市第{n}天行程：上午外滩，下午豫园。", "好的。", "  ", "请问哪个城市的酒店，什么时候入住？",
    "能否再说一次？", "已为您查到杭州西湖附近酒店，评分：4.{k}分，交通便利。", "rating {k}/10, close to the station", "8.{n} / 10 by guests", "房间干净，服务{k}分，价格便宜。", "抱歉 暂时 无法 提供！！", "Plain prose, event {n}.",
)
REFUSAL = "抱歉，暂时无法提供。"
APPROVED = ("抱歉暂时无法提供", REFUSAL)


def _replies(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    n, k = F.col("event_id").cast("string"), F.get_json_object("props", "$.k")
    text = F.replace(F.replace(F.element_at(F.array(*map(F.lit, REPLIES)), (F.col("event_id") % len(REPLIES) + 1).cast("int")), F.lit("{n}"), n), F.lit("{k}"), k)
    e = e.withColumn("text", text)
    act = dialogue.act(F.col("text"), APPROVED, F.col("user_id") % 4 == 0)
    named = F.when(F.col("user_id") % 3 == 0, F.array(F.lit("上海市"), F.lit(None))).when(F.col("user_id") % 3 == 1, F.array(F.lit("杭 州"))).otherwise(F.array(F.lit(None).cast("string")))
    part = F.when(F.col("event_id") % 3 == 0, "noon").when(F.col("event_id") % 3 == 1, "day").otherwise("night")
    return e.select("event_id", act.alias("a"), dialogue.substantial(F.col("text"), named).alias("substantial"), dialogue.rating(F.col("text")).alias("rating"), dialogue.weather(k, part).alias("weather")).select("event_id", "a.act", "a.slot", "a.rule", "substantial", "rating", "weather")


QUERIES["replies"] = _replies


def _replies_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    hit = {s: f"regexp_matches(text, {quoted(p)})" for s, _, p in dialogue.QUESTIONS}
    hit["destination"] += f" AND NOT {hit['route_destination']}"
    slots = "list_filter([" + ", ".join(f"CASE WHEN {h} THEN '{s}' END" for s, h in hit.items()) + "], lambda x: x IS NOT NULL)"
    strip = lambda t: f"regexp_replace(regexp_replace({t}, '\\s+', '', 'g'), '[。.!！]+$', '')"
    refused = " OR ".join([f"regexp_matches(text, {quoted(dialogue.REFUSES)})", *(f"{strip('text')} = {strip(quoted(r))}" for r in APPROVED)])
    rate = ", ".join(f"CASE WHEN try_cast(regexp_extract(raw, {quoted(p)}, 1) AS DOUBLE) <= {s} THEN {'round(' if s == 10 else ''}try_cast(regexp_extract(raw, {quoted(p)}, 1) AS DOUBLE){' / 2, 1)' if s == 10 else ''} END" for p, s in dialogue.RATINGS)
    labels = " ".join(f"WHEN {c} THEN '{w}'" for c, w in dialogue.WEATHER.items())
    return f"""
WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k, replace(replace([{', '.join(map(quoted, REPLIES))}][event_id % {len(REPLIES)} + 1], '{{n}}', event_id::VARCHAR), '{{k}}', json_extract_string(props, '$.k')) AS raw FROM events),
t AS (SELECT *, trim(raw) AS text, regexp_replace(raw, '\\s+', '', 'g') AS compact, CASE user_id % 3 WHEN 0 THEN '上海' WHEN 1 THEN '杭州' END AS entity FROM e),
s AS (SELECT *, {slots} AS slots, regexp_extract_all(compact, '[㐀-鿿]') AS signs FROM t),
a AS (
  SELECT *, CASE WHEN text = '' THEN 'invalid' WHEN {refused} THEN 'refusal' WHEN user_id % 4 = 0 THEN 'final' WHEN len(slots) > 1 THEN 'invalid' WHEN len(slots) = 1 OR regexp_matches(text, {quoted(dialogue.ASKS)}) THEN 'ask' ELSE 'final' END AS act FROM s)
SELECT event_id, act, CASE WHEN act = 'ask' THEN coalesce(slots[1], 'unknown') END AS slot,
       CASE WHEN text = '' THEN 'empty' WHEN act = 'invalid' THEN 'multiple_questions' WHEN act = 'ask' THEN 'ask.' || coalesce(slots[1], 'unknown') || '.v1' END AS rule,
       length(compact) >= 12 AND len(signs) >= 6 AND len(list_distinct(signs)) >= 4 AND (entity IS NULL OR contains(compact, entity)) AS substantial, coalesce({rate}) AS rating,
       CASE WHEN event_id % 3 = 0 THEN '未知' ELSE CASE k::INT {labels} ELSE '未知' END END AS weather FROM a"""


ORACLES["replies"] = _replies_sql()
