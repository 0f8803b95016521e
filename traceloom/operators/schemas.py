"""Record validation from a schema, compiled to column expressions over variants; no Python runs on rows.

A schema is a dict in a subset of JSON Schema: type (one or several), required,
properties, additionalProperties (false alone), items, enum, minimum, maximum,
minLength, maxLength, minItems, maxItems, pattern, format date, and default.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.scalar import let

FINDING = "struct<path:string,rule:string,found:string>"
KNOWN = {"type", "required", "properties", "additionalProperties", "items", "enum", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "pattern", "format", "default"}
#: Spark's types of the values of simple schema types.
SIMPLE = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}


def kind(v: Column) -> Column:
    """The JSON type of a variant: a boolean is no integer; a number without a fraction is one. Null where there is no value."""
    return let(F.schema_of_variant(v), lambda t: (
        F.when(t.isNull(), None).when(t == "VOID", "null").when(t == "BOOLEAN", "boolean").when(t == "STRING", "string")
        .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").when((t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer").otherwise("number")))


def _none() -> Column:
    return F.expr(f"cast(array() AS array<{FINDING}>)")


def _key(name: str) -> str:
    """Path of a property; variant paths have no escapes, so its name may hold one kind of quotes and no question mark."""
    quote = "'" if "'" not in name else '"'
    if quote in name or "?" in name or not name:
        raise ValueError(f"no path to the property {name!r}")
    return f"$[{quote}{name}{quote}]"


def _is(t: Column, name: str) -> Column:
    """Whether a JSON value whose Spark type is ``t`` has a schema type; integers are numbers."""
    simple = {"null": "VOID", "boolean": "BOOLEAN", "string": "STRING"}
    if name in simple:
        return t == simple[name]
    if name in ("object", "array"):
        return t.startswith(name.upper())
    if name == "integer":
        return (t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$")
    return (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL") if name == "number" else F.lit(False)


def _found(path: Column, rule: str, value: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(rule).alias("rule"), value.alias("found"))


def _checks(v: Column, schema: dict, test: Callable[[str], Column | bool], n_items: Column) -> list[tuple[str, Column]]:
    """(rule, broken) of the schema's limits; each looks only at values of its own type, and one that ``test`` rules out is left out."""
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
    limits: dict[str, tuple[str, Callable[[object], Column]]] = {
        "minimum": ("number", lambda x: number < x), "maximum": ("number", lambda x: number > x), "minLength": ("string", lambda x: F.length(text) < x), "maxLength": ("string", lambda x: F.length(text) > x),
        "minItems": ("array", lambda x: n_items < x), "maxItems": ("array", lambda x: n_items > x), "pattern": ("string", lambda x: ~text.rlike(x)),
        "format": ("string", lambda x: ~(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull())),
        "enum": ("", lambda x: ~F.coalesce(F.to_json(v).isin(*(json.dumps(e, ensure_ascii=False, separators=(",", ":")) for e in x)), F.lit(False)))}
    out = []
    for rule, (of, limit) in limits.items():
        own = test(of) if of else True
        if rule in schema and own is not False:
            out.append((rule, limit(schema[rule]) if own is True else own & limit(schema[rule])))
    return out


def _findings(v: Column, schema: dict, path: Column) -> Column:
    """Findings on a value that is there; ``v`` is named several times, so it has to be a bound one.

    Where one type alone is allowed, a value that is read as it has it, and only
    others are asked what they are.
    """
    unknown = set(schema) - KNOWN
    if unknown or schema.get("format", "date") != "date" or schema.get("additionalProperties", False) is not False:
        raise ValueError(f"not in the schema subset: {sorted(unknown) or schema}")
    types = [schema["type"]] if isinstance(schema.get("type"), str) else schema.get("type", [])
    wrong = lambda is_: F.array(_found(path, "type", is_))
    only = types[0] if len(types) == 1 else None
    known = (lambda name: name == only or (name, only) == ("number", "integer")) if only else None
    if only == "object" and schema.get("properties"):
        return let(_members(v, schema), lambda o: F.when(o.isNull(), wrong(kind(v))).otherwise(_node(v, schema, path, known, o, None)))
    if only == "array":
        return let(F.try_variant_get(v, "$", "array<variant>"), lambda a: F.when(a.isNull(), wrong(kind(v))).otherwise(_node(v, schema, path, known, None, a)))
    if not types and not set(schema) - {"default"}:
        return _none()

    def judge(t: Column) -> Column:
        test = known or (lambda name: _is(t, name))
        inner = let(F.struct(_members(v, schema).alias("o"), F.try_variant_get(v, "$", "array<variant>").alias("a")), lambda n: _node(v, schema, path, test, n["o"], n["a"])) if set(schema) & {"properties", "required", "items", "minItems", "maxItems"} else _node(v, schema, path, test, None, None)
        if not types:
            return inner
        fits = _is(t, types[0])
        for name in types[1:]:
            fits = fits | _is(t, name)
        return F.when(fits, inner).otherwise(wrong(kind(v)))

    return let(F.schema_of_variant(v), judge)


def _members(v: Column, schema: dict) -> Column:
    """Struct m0, m1 and so on of the schema's properties as variants, read at once; null where the value is no object."""
    names = list(schema.get("properties", {}))
    for name in names:
        _key(name)
    if not names:
        return F.lit(None).cast("struct<m0:variant>")
    quoted = ("`" + name.replace("`", "``") + "`" for name in names)
    return F.try_variant_get(v, "$", "struct<" + ",".join(f"{q}:variant" for q in quoted) + ">").cast("struct<" + ",".join(f"m{i}:variant" for i in range(len(names))) + ">")


def _node(v: Column, schema: dict, path: Column, test: Callable[[str], Column | bool], o: Column | None, a: Column | None) -> Column:
    """Findings on a value of a type that fits: its own, then those of its properties, of further keys and of its items."""
    own = [(broken, _found(path, rule, F.to_json(v))) for rule, broken in _checks(v, schema, test, F.size(a) if a is not None else F.lit(None))]
    deeper = []
    properties = schema.get("properties", {})
    for i, (name, inside) in enumerate(properties.items() if o is not None else ()):
        child, at = o[f"m{i}"], F.concat(path, F.lit(f".{name}"))
        if name in schema.get("required", ()):
            own.append((o.isNotNull() & child.isNull(), _found(at, "required", F.lit(None).cast("string"))))
        deeper.append(F.when(child.isNotNull(), _findings(child, inside, at)).otherwise(_none()))
    if "additionalProperties" in schema and test("object") is not False:
        extra = F.filter(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), lambda k: ~k.isin(*properties) if properties else F.lit(True))
        deeper.append(F.coalesce(F.transform(extra, lambda k: _found(F.concat(path, F.lit("."), k), "additionalProperties", F.lit(None).cast("string"))), _none()))
    if "items" in schema and a is not None:
        each = F.transform(a, lambda x, i: _findings(x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        deeper.append(F.coalesce(F.flatten(each), _none()))
    if own:
        some = own[0][0]
        for broken, _ in own[1:]:
            some = some | broken
        all_ = F.array(own[0][1]) if len(own) == 1 else F.filter(F.array(*(F.when(broken, f) for broken, f in own)), lambda f: f.isNotNull())
        deeper.insert(0, F.when(some, all_).otherwise(_none()))
    if len(deeper) > 1:
        return F.flatten(F.array(*deeper))
    return deeper[0] if deeper else _none()


def violations(value: Column, schema: dict) -> Column:
    """Array of (path, rule, found) of a JSON text against the schema; empty for a valid one.

    A null value breaks the rule ``required`` at ``$``, a text that is no JSON,
    or that has a key twice, the rule ``json``. A value of the wrong type has
    that finding alone. ``found`` is the value as JSON, or its type.
    """
    one = lambda rule, found: F.array(F.struct(F.lit("$").alias("path"), F.lit(rule).alias("rule"), found.alias("found")))
    judge = lambda n: F.when(n["text"].isNull(), one("required", F.lit(None).cast("string"))).when(n["v"].isNull(), one("json", n["text"])).otherwise(_findings(n["v"], schema, F.lit("$")))
    return let(F.struct(value.alias("text"), F.try_parse_json(value).alias("v")), judge)


def _property(v: Column, name: str, inside: dict) -> Column:
    to = SIMPLE.get(inside.get("type")) if isinstance(inside.get("type"), str) else None
    got = F.try_variant_get(v, _key(name), to or "variant")
    if "default" in inside:
        got = F.coalesce(got, F.lit(inside["default"]).cast(to) if to else F.parse_json(F.lit(json.dumps(inside["default"]))))
    return got.alias(name)


def filled(value: Column, schema: dict) -> Column:
    """Struct of the schema's top-level properties, absent ones by their default; null where the value breaks the schema.

    Simple types become Spark's; objects, arrays and several types stay variants.
    """
    def fill(v: Column) -> Column:
        return F.struct(*(_property(v, name, inside) for name, inside in schema["properties"].items()))

    return F.when(F.size(violations(value, schema)) == 0, let(F.try_parse_json(value), fill))


def findings(rows: DataFrame, key: list[str], value: Column, schema: dict) -> DataFrame:
    """(key, path, rule, found), a row a finding. No shuffle; valid records give none."""
    return rows.select(*key, F.explode(violations(value, schema)).alias("f")).select(*key, "f.*")


def schema_from_rows(rows: DataFrame, most: int = 10_000) -> dict:
    """A schema given as a table of (path, rule, value), values as JSON: $.a.b is property b of a, [] the items of an array.

    The table is a parameter of at most ``most`` rows, more are an error. Rule
    ``required`` true stands at the property it asks for.
    """
    read = rows.select("path", "rule", "value").limit(most + 1).collect()
    if len(read) > most:
        raise ValueError(f"a schema of more than {most} rows")
    root: dict = {}
    for path, rule, value in sorted(read):
        node, parent, name = root, None, None
        for step in path.replace("[]", ".[]").split(".")[1:]:
            parent, name = node, step
            node = node.setdefault("items", {}) if step == "[]" else node.setdefault("properties", {}).setdefault(step, {})
        if rule == "required":
            if json.loads(value):
                parent.setdefault("required", []).append(name)
        else:
            node[rule] = json.loads(value)
    return root
