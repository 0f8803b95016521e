"""JSON as typed leaves: what two values differ in, by path.

A value is the set of its leaves, each with a path, a type and a text. Empty
objects and arrays are leaves. Two values are equal if their leaves are.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

LEAVES = ArrayType(StructType([StructField(n, StringType()) for n in ("path", "type", "value")]))
PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON number")


def read_json(text: str | None):
    """The value of a JSON text; ValueError where it is none, NaN and infinities included."""
    if text is None:
        raise ValueError("no text")
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        raise ValueError("nested too deeply") from None


def scalar_leaf(value, one_number: bool = True) -> tuple[str, str | None]:
    """(type, text) of a value without parts. A whole float is the integer of its value if ``one_number``."""
    if value is None:
        return "null", None
    if isinstance(value, bool):
        return "boolean", str(value).lower()
    if isinstance(value, str):
        return "string", value
    if isinstance(value, float):
        whole = one_number and value == value and abs(value) != float("inf") and value.is_integer()
        return "number", str(int(value)) if whole else repr(value)
    return ("number" if one_number else "integer"), str(value)


def leaves(value, one_number: bool = True) -> dict[str, tuple[str, str | None]]:
    """Path to (type, text) of every leaf. A key of other than letters, digits and _ is quoted in its path."""
    found, todo = {}, [("$", value)]
    while todo:
        path, v = todo.pop()
        if isinstance(v, dict) and v:
            todo += [(f"{path}.{k}" if PLAIN.fullmatch(k) else f"{path}.{json.dumps(k)}", x) for k, x in v.items()]
        elif isinstance(v, list) and v:
            todo += [(f"{path}[{i}]", x) for i, x in enumerate(v)]
        elif isinstance(v, (dict, list)):
            found[path] = ("object" if isinstance(v, dict) else "array"), None
        else:
            found[path] = scalar_leaf(v, one_number)
    return found


@F.pandas_udf(LEAVES)
def json_leaves(texts: pd.Series) -> pd.Series:
    """Leaves of JSON texts in order of path; null where a text is no JSON."""

    def of(text):
        try:
            return [{"path": p, "type": t, "value": v} for p, (t, v) in sorted(leaves(read_json(text)).items())]
        except ValueError:
            return None

    return texts.map(of)


def same(a, b, one_number: bool = True) -> bool:
    """Whether two values have the same leaves. A boolean is never a number; an integer is a float of its value only if ``one_number``."""
    return leaves(a, one_number) == leaves(b, one_number)


def _distinct_keys(pairs: list[tuple]) -> dict:
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("two keys are one")
    return dict(pairs)


def canonical(text: str | None, composed: bool = True) -> str | None:
    """A JSON text with sorted keys; ``composed``: without spaces and with NFC strings. Null where the text is no JSON or two keys become one."""
    try:
        if not composed:
            return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True)
        # Signs of JSON compose with nothing, so the whole text can be brought to NFC.
        plain = unicodedata.normalize("NFC", json.dumps(read_json(text), ensure_ascii=False))
        return json.dumps(json.loads(plain, object_pairs_hook=_distinct_keys), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except (TypeError, ValueError, RecursionError):
        return None
