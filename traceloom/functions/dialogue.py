"""What a reply is and whether it says enough: acts, refusals, substance, ratings, weather words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What asks for a slot, the name of the rule, marks of any question, and how a refusal by topic reads.
QUESTIONS = (
    ("travel_date", "ask.travel_date.v1", r"(?i)(?:请问|请告诉|能否|可以|方便|想问|计划)?[^。！!]{0,24}(?:什么时候|哪天|几号|什么日期|出发时间|出行时间|旅行日期)|(?:什么时候|哪天|几号)[^。！!]{0,16}(?:出发|去|旅行|出行)"),
    ("hotel_name", "ask.hotel_name.v1", r"(?i)(?:哪家|什么|哪个)[^。！!]{0,8}(?:酒店|宾馆|旅馆)|(?:酒店|宾馆|旅馆)[^。！!]{0,8}(?:名字|名称|哪家)|想了解哪家酒店"),
    ("hotel_city", "ask.hotel_city.v1", r"(?i)(?:哪个|哪座|什么)[^。！!]{0,5}(?:城市|地方)[^。！!]{0,12}(?:酒店|住宿)|(?:酒店|住宿)[^。！!]{0,12}(?:哪个|哪座|什么)(?:城市|地方)"),
    ("route_destination", "ask.route_destination.v1", r"(?i)(?:路线|怎么走|导航)[^。！!]{0,18}(?:去哪|去哪里|到哪|目的地|终点)|(?:终点|路线目的地)[^。！!]{0,8}(?:哪里|哪儿|什么)"),
    ("destination", "ask.destination.v1", r"(?i)(?:想|打算|计划|准备)?(?:去|到)(?:哪里|哪儿|哪个城市|什么地方)|(?:目的地|旅行城市|旅游城市)[^。！!]{0,10}(?:哪里|哪儿|哪个|什么)|请告诉我[^。！!]{0,8}(?:哪个城市|目的地)"),
)
ASKS = r"[?？]|(?:请问|请告诉|能否|可以告诉|方便告诉|想问)"
UNKNOWN_ASK = ("unknown", "ask.unknown.v1")
REFUSES = r"(?i)(?:抱歉|不好意思)[^。！!]{0,40}(?:旅行|旅游)[^。！!]{0,20}(?:只能|仅能|只回答|无法回答)[^。！!]{0,24}(?:相关|问题|内容)"
# A slot whose question also reads as the other's.
WIDER = {"route_destination": "destination"}
# How much a whole answer has: characters besides spaces, ideographs, different ideographs.
LEAST_CHARS, LEAST_IDEOGRAPHS, LEAST_DIFFERENT = 12, 6, 4
# Ratings in order of trust, with their scale.
RATINGS = ((r"(?i)(?:评分|评分为|rating)\s*[:：]?\s*(\d(?:\.\d+)?)\s*(?:分|/\s*5)?", 5), (r"(\d(?:\.\d+)?)\s*/\s*5", 5), (r"(\d(?:\.\d+)?)\s*/\s*10", 10), (r"(\d(?:\.\d+)?)\s*分", 5))
# Labels of weather codes, the same by day and by night, and that of any other code.
WEATHER = {
    0: "晴", 1: "晴", 2: "多云", 3: "阴", 45: "雾", 48: "雾", 51: "小雨", 53: "小雨", 55: "中雨", 61: "小雨", 63: "中雨", 65: "大雨",
    71: "小雪", 73: "中雪", 75: "大雪", 77: "雪", 80: "小雨", 81: "中雨", 82: "大雨", 85: "小雪", 86: "大雪", 95: "雷阵雨", 96: "雷阵雨", 99: "雷阵雨",
}
NO_WEATHER = "未知"


def without_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def plain_refusal(text: Column) -> Column:
    """Without spaces, and without stops and exclamation marks at the end."""
    return F.regexp_replace(without_spaces(text), r"[。.!！]+$", "")


def act(text: Column, refusals: tuple[str, ...] = (), completes: Column | None = None) -> Column:
    """Struct (act, slot, rule) of a reply; null and blank texts are invalid.

    ``refusal``: one of the approved texts, or one that declines by topic.
    ``final``: any other text where ``completes``. ``ask``: with the slot whose
    question it is, or an unknown one; ``invalid`` where it asks for several.
    Else ``final``.
    """
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))
    told = lambda a, slot=None, rule=None: F.struct(F.lit(a).alias("act"), F.lit(slot).cast("string").alias("slot"), F.lit(rule).cast("string").alias("rule"))
    hits = {s: plain.rlike(p) for s, _, p in QUESTIONS}
    for narrow, wide in WIDER.items():
        hits[wide] = hits[wide] & ~hits[narrow]
    asked = F.filter(F.array(*(F.when(hits[s], told("ask", s, rule)) for s, rule, _ in QUESTIONS)), lambda x: x.isNotNull())
    refused = plain.rlike(REFUSES)
    for r in refusals:
        refused = refused | (plain_refusal(plain) == plain_refusal(F.lit(r)))
    ready = F.coalesce(completes, F.lit(False)) if completes is not None else F.lit(False)
    return (
        F.when(plain == "", told("invalid", None, "empty")).when(refused, told("refusal")).when(ready, told("final")).when(F.size(asked) > 1, told("invalid", None, "multiple_questions"))
        .when(F.size(asked) == 1, F.get(asked, F.lit(0))).when(plain.rlike(ASKS), told("ask", *UNKNOWN_ASK)).otherwise(told("final")))


def substantial(text: Column, entities: Column) -> Column:
    """Whether an answer says enough and names one of ``entities``, an array, of which nulls and blanks do not count; none asks for none.

    Entities match without spaces and without a closing 市.
    """
    compact = without_spaces(F.coalesce(text, F.lit("")))
    signs = F.regexp_extract_all(compact, F.lit("([㐀-鿿])"), F.lit(1))
    bare = F.transform(entities, lambda e: F.regexp_replace(without_spaces(F.coalesce(e, F.lit(""))), "^(.+)市$", "$1"))
    named = F.filter(bare, lambda e: e != "")
    return (F.length(compact) >= LEAST_CHARS) & (F.size(signs) >= LEAST_IDEOGRAPHS) & (F.size(F.array_distinct(signs)) >= LEAST_DIFFERENT) & ((F.size(named) == 0) | F.exists(named, lambda e: compact.contains(e)))


def rating(text: Column) -> Column:
    """The first rating by order of the patterns, on five points: those of ten are halved, to one place. A value beyond its scale does not count."""
    found = []
    for pattern, scale in RATINGS:
        value = F.regexp_extract(text, pattern, 1).try_cast("double")
        found.append(F.when(value <= scale, F.round(value / 2, 1) if scale == 10 else value))
    return F.coalesce(*found)


def weather(code: Column, part: Column | None = None) -> Column:
    """The label of a weather code by ``day`` or ``night``, day if none is given; unknown codes and parts have their own label."""
    labels = F.create_map(*[F.lit(x) for pair in WEATHER.items() for x in pair])
    label = F.coalesce(F.try_element_at(labels, code.cast("int")), F.lit(NO_WEATHER))
    return label if part is None else F.when(part.isin("day", "night"), label).otherwise(NO_WEATHER)
