"""Column expressions on records: normalisation, aliases, dates, distances, codes and JSON. Null in gives null out unless said otherwise."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from traceloom.functions import leaves


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def alias(c: Column, classes: list[tuple[str, str]]) -> Column:
    """The name of the first class whose pattern matches the whole value, else the value."""
    out = c
    for pattern, name in reversed(classes):
        out = F.when(c.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def keep_amount(c: Column, pattern: str, template: str) -> Column:
    """``template`` with ``$1`` replaced by the amount, where ``pattern`` matches the whole value; else the value."""
    whole = f"^(?:{pattern})$"
    return F.when(c.rlike(whole), F.regexp_replace(c, whole, template)).otherwise(c)


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def normalise(c: Column, steps: tuple[str, ...]) -> Column:
    """A string, or an array for ``sort_unique``, after the named steps in order; an unknown step is an error."""
    known = {"unicode_nfkc": nfkc, "trim": F.trim, "lowercase": F.lower, "uppercase": F.upper, "sort_unique": lambda x: F.array_sort(F.array_distinct(x))}
    for step in steps:
        if step not in known:
            raise ValueError(f"no normalisation {step}")
        c = known[step](c)
    return c


def path_value(c: Column, path: str) -> Column:
    """The value at a dotted path of a JSON text; a missing one is an error."""
    found = F.get_json_object(c, "$." + path)
    return F.coalesce(found, F.raise_error(F.concat(F.lit(f"no {path} in "), F.coalesce(c, F.lit("null")))))


def km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Equirectangular distance: 111 km a degree, longitude by the cosine of the mean latitude."""
    x = (lon_a - lon_b) * F.cos(F.radians((lat_a + lat_b) / 2))
    y = lat_a - lat_b
    return 111.0 * F.sqrt(x * x + y * y)


def fixed_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Distance at 111 km a degree of latitude and 85 of longitude."""
    x, y = (lon_a - lon_b) * 85.0, (lat_a - lat_b) * 111.0
    return F.sqrt(x * x + y * y)


def date_range(c: Column) -> Column:
    """Struct (first, last, days) of ``a~b`` or of a single date, both ends included."""
    first = F.to_date(F.trim(F.split_part(c, F.lit("~"), F.lit(1))))
    last = F.when(c.contains("~"), F.to_date(F.trim(F.split_part(c, F.lit("~"), F.lit(2))))).otherwise(first)
    return F.struct(first.alias("first"), last.alias("last"), (F.date_diff(last, first) + 1).cast("long").alias("days"))


def bounded_stay(base: Column, seed: Column, horizon: int = 16, least: int = 3, most: int = 12, longest: int = 7) -> Column:
    """Struct (start, nights): an offset of ``least`` to ``most`` days, and a length whose end lies within the horizon."""
    offset = least + F.pmod(seed, F.lit(most - least + 1))
    nights = F.least(1 + F.pmod(F.floor(seed / 100), F.lit(longest)), F.lit(horizon) - offset)
    return F.struct(F.date_add(F.to_date(base), offset.cast("int")).alias("start"), nights.cast("long").alias("nights"))


def weekday(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def rewrite_codes(c: Column, codes: dict[str, str]) -> Column:
    """Six-digit codes replaced where they stand alone."""
    for old, new in codes.items():
        c = F.regexp_replace(c, rf"(?<!\d){old}(?!\d)", new)
    return c


def largest_amount(c: Column, low: int = 30, high: int = 99999) -> Column:
    """The largest plausible number of a text; null without one."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(\d{1,9})"), F.lit(1)), lambda x: x.cast("long"))
    return F.array_max(F.filter(found, lambda x: x.between(low, high)))


def keywords(c: Column, stop: tuple[str, ...]) -> Column:
    """Distinct lower-cased words of over one letter that are no stop words, sorted."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"([a-z0-9]+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*stop))))


@F.pandas_udf(StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """Sorted keys, no spaces, NFC strings; null where the text is no JSON, has NaN, or two keys become one."""
    return values.map(leaves.canonical)


@F.pandas_udf(StringType())
def loose_json(values: pd.Series) -> pd.Series:
    """Sorted keys with the usual spaces, strings as they are; null where the text is no JSON."""
    return values.map(lambda v: leaves.canonical(v, composed=False))


def json_equal(numbers_agree: bool = True):
    """A pandas UDF of two JSON texts: whether they have the same leaves; false where either is no JSON."""

    @F.pandas_udf("boolean")
    def equal(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            try:
                return leaves.same(leaves.read_json(x), leaves.read_json(y), numbers_agree)
            except ValueError:
                return False

        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="bool")

    return equal


def far_route(c: Column) -> Column:
    """Estimates between towns ``c`` km apart as the crow flies: a quarter more by road, minutes, metres, fare and tolls."""
    road = c * 1.25
    return F.struct(
        F.floor(road / 150 * 60 + 40).alias("transit_min"), F.round(road * 0.45, 1).alias("fare"), F.floor(road / 85 * 60).alias("driving_min"),
        F.floor(road * 1000).alias("metres"), F.round(road * 0.5, 1).alias("tolls"))


def near_route(c: Column) -> Column:
    """Estimates within a town over ``c`` km as the crow flies: three tenths more on foot, minutes, metres and fare."""
    m = F.floor(c * 1000 * 1.3)
    over = lambda n: F.floor(m / n)
    return F.struct(
        F.greatest(F.lit(1), over(80)).alias("walking_min"), F.greatest(F.lit(5), over(250) + 8).alias("transit_min"), (over(5000) + 2).cast("double").alias("fare"),
        F.greatest(F.lit(2), over(400)).alias("driving_min"), m.alias("metres"))


#: Words of approximation, the word after a number, marks of degrees, and signs of weather that are no plan.
HEDGES = "大概|大致|约|大约"
AFTER = "左右"
DEGREES = "℃|°C|度"
RANGE = "~|-|至|到"
WEATHER_SIGNS = r"[\d℃°~\-\s，,。晴阴雨云多小中大雪雾雷]"


def plain_degrees(c: Column) -> Column:
    """Temperatures and ranges of them without words of approximation; the numbers stay."""
    number, mark = r"-?\d+\s*", f"(?:{DEGREES})"
    for span in (rf"{number}(?:{RANGE})\s*{number}{mark}", rf"{number}{mark}"):
        c = F.regexp_replace(c, rf"(?:{HEDGES})\s*({span})", "$1")
    return F.regexp_replace(c, rf"({number}{mark})\s*{AFTER}", "$1")


def planned_days(c: Column, days: list[tuple[str, ...]], least: int = 25) -> Column:
    """Per day, given by its written forms: whether the text from its mention to the next later one holds a plan, null if it is not mentioned.

    A plan has at least so many characters that are no signs of weather. Of
    several mentions the first of each form counts, and of the forms the last.
    """
    at = [F.greatest(*[F.instr(c, form) for form in forms], F.lit(0)) for forms in days]

    def holds(i: int) -> Column:
        later = [F.when(p > at[i], p) for p in at[i + 1 :]]
        end = F.least(*later, F.length(c) + 1) if later else F.length(c) + 1
        plan = F.regexp_replace(F.substr(c, at[i], end - at[i]), WEATHER_SIGNS, "")
        return F.when(at[i] > 0, F.length(plan) >= least)

    return F.array(*[holds(i) for i in range(len(days))])
