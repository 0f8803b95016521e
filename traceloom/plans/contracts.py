"""Queries of schema validation, of the audit of two versions, of exact selection and of mixed batches, with their SQL.

The given tables hold few JSON texts, so records are made from their columns,
with faults put in by rule: each finding occurs, and the SQL states the rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators import differences, sampling, schemas, selection
from traceloom.session import table, width

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, tables: str, query: Callable, sql: str) -> None:
    QUERIES[name] = lambda spark, d: query(*(table(spark, d, t) for t in tables.split()))
    ORACLES[name] = sql


#: (path, rule, value as JSON).
EVENT_SCHEMA = [
    ("$", "type", '"object"'), ("$", "additionalProperties", "false"), ("$.k", "required", "true"), ("$.k", "type", '"integer"'), ("$.k", "maximum", "90"), ("$.kind", "required", "true"),
    ("$.kind", "enum", '["error", "click", "view", "purchase"]'), ("$.at", "type", '"string"'), ("$.at", "format", '"date"'), ("$.tags", "type", '"array"'), ("$.tags[]", "type", '"string"'),
    ("$.inner", "type", '"object"'), ("$.inner.ok", "type", '"boolean"'), ("$.inner.ok", "required", "true"), ("$.inner.rank", "type", '["integer", "null"]'), ("$.days", "type", '"integer"'), ("$.days", "default", "1"),
]


def _event_json() -> Column:
    n, k = F.col("event_id"), F.get_json_object("props", "$.k")
    put = lambda every, bad, good: F.when(n % every == 0, bad).otherwise(good)
    text = F.concat(
        F.lit('{"k": '), put(11, F.concat(F.lit('"'), k, F.lit('"')), put(13, F.lit("null"), k)), put(17, F.lit(', "odd": 1'), F.lit("")),
        put(19, F.lit(""), F.concat(F.lit(', "kind": "'), "event_type", F.lit('"'))), F.lit(', "at": "'), put(23, F.lit("2024-13-45"), F.date_format("ts", "yyyy-MM-dd")), F.lit('", "tags": ["a", '), put(29, F.lit("5"), F.lit('"b"')),
        F.lit('], "inner": {"ok": '), put(31, F.lit("1"), F.lit("true")), put(3, F.lit(', "rank": null'), F.lit("")), F.lit("}"), put(2, F.concat(F.lit(', "days": '), n % 5), F.lit("")), F.lit("}"))
    return put(41, F.lit(None).cast("string"), put(37, F.lit("{k"), text))


def _schema(rows: DataFrame) -> dict:
    return schemas.schema_from_rows(rows.sparkSession.createDataFrame(EVENT_SCHEMA, "path string, rule string, value string"))


VALID = """
WITH e AS (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k, event_id % 41 <> 0 AND event_id % 37 <> 0 AS json FROM events),
f AS (
  SELECT event_id, '$' AS path, 'required' AS rule FROM e WHERE event_id % 41 = 0
  UNION ALL SELECT event_id, '$', 'json' FROM e WHERE event_id % 37 = 0 AND event_id % 41 <> 0
  UNION ALL SELECT event_id, '$.k', 'type' FROM e WHERE json AND (event_id % 11 = 0 OR event_id % 13 = 0)
  UNION ALL SELECT event_id, '$.k', 'maximum' FROM e WHERE json AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND k > 90
  UNION ALL SELECT event_id, '$.odd', 'additionalProperties' FROM e WHERE json AND event_id % 17 = 0
  UNION ALL SELECT event_id, '$.kind', 'required' FROM e WHERE json AND event_id % 19 = 0
  UNION ALL SELECT event_id, '$.kind', 'enum' FROM e WHERE json AND event_id % 19 <> 0 AND event_type = 'signup'
  UNION ALL SELECT event_id, '$.at', 'format' FROM e WHERE json AND event_id % 23 = 0
  UNION ALL SELECT event_id, '$.tags[1]', 'type' FROM e WHERE json AND event_id % 29 = 0
  UNION ALL SELECT event_id, '$.inner.ok', 'type' FROM e WHERE json AND event_id % 31 = 0)"""

_add("schema_findings", "events", lambda e: schemas.findings(e, ["event_id"], _event_json(), _schema(e)).select("event_id", "path", "rule"), VALID + " SELECT event_id, path, rule FROM f")

_add("schema_defaults", "events", lambda e: e.select("event_id", schemas.filled(_event_json(), _schema(e)).alias("r")).select("event_id", F.col("r").isNotNull().alias("valid"), "r.k", "r.days", F.to_date("r.at").alias("at")), VALID + """
SELECT event_id, v AS valid, CASE WHEN v THEN k END AS k, CASE WHEN v THEN CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE 1 END END AS days, CASE WHEN v THEN ts::DATE END AS at
FROM (SELECT *, event_id NOT IN (SELECT event_id FROM f) AS v FROM e)""")

ORDER_SCHEMA = {
    "type": "object", "required": ["o_orderkey", "lines"], "additionalProperties": False,
    "properties": {
        "o_orderkey": {"type": "integer", "minimum": 1}, "o_orderstatus": {"type": "string", "enum": ["O", "F"]}, "o_totalprice": {"type": "number", "maximum": 300000}, "o_orderpriority": {"type": "string", "pattern": "^[1-5]-"},
        "lines": {"type": "array", "minItems": 1, "maxItems": 5, "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}, "q": {"type": "number", "maximum": 40}, "flag": {"type": "string", "maxLength": 1, "enum": ["A", "N"]}}}},
    },
}


def _orders(o: DataFrame, l: DataFrame) -> DataFrame:
    """Orders with their lines as nested records, on all of the session's partitions: judging them costs far more than their bytes tell Spark."""
    n = width(o.sparkSession)
    lines = l.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").repartition(n, "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("double").alias("q"), F.col("l_returnflag").alias("flag")))).alias("lines"))
    return o.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority").repartition(n, "o_orderkey").join(lines, "o_orderkey", "left")


_add("schema_of_nested", "orders lineitem", lambda o, l: schemas.findings(_orders(o, l), ["o_orderkey"], F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "lines")), ORDER_SCHEMA).groupBy("rule", F.regexp_replace("path", r"\d+", "#").alias("place")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least")), """
WITH f AS (
  SELECT 'minimum' AS rule, '$.o_orderkey' AS place, o_orderkey AS k FROM orders WHERE o_orderkey < 1
  UNION ALL SELECT 'enum' AS rule, '$.o_orderstatus' AS place, o_orderkey AS k FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
  UNION ALL SELECT 'maximum', '$.o_totalprice', o_orderkey FROM orders WHERE o_totalprice > 300000
  UNION ALL SELECT 'pattern', '$.o_orderpriority', o_orderkey FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-')
  UNION ALL SELECT 'required', '$.lines', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'maxItems', '$.lines', l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 3 HAVING count(*) > 5
  UNION ALL SELECT 'maximum', '$.lines[#].q', l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 40
  UNION ALL SELECT 'enum', '$.lines[#].flag', l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag NOT IN ('A', 'N'))
SELECT rule, place, count(*) AS n, min(k) AS least FROM f GROUP BY 1, 2""")


def _versions(o: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders with a JSON column, and a later version with faults by rule."""
    n = F.col("o_orderkey")
    doc = lambda a, b: F.concat(F.lit('{"p": {"list": [1, '), a, F.lit("]}"), b, F.lit("}"))
    left = o.where(n % 23 != 0).select("o_orderkey", "o_orderstatus", "o_totalprice", F.struct("o_custkey", "o_orderdate").alias("of"), doc((n % 3).cast("string"), F.lit("")).alias("doc"))
    moved = F.struct((F.col("o_custkey") + F.when(n % 13 == 0, 1).otherwise(0)).alias("o_custkey"), "o_orderdate")
    list_ = F.when(n % 11 == 0, F.concat(F.lit('"'), n % 3, F.lit('"'))).when(n % 17 == 0, F.concat((n % 3).cast("string"), F.lit(", 9"))).otherwise(F.concat((n % 3).cast("string"), F.lit(".0")))
    right = o.where(n % 29 != 0).select(
        "o_orderkey", F.when(n % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice", moved.alias("of"), doc(list_, F.when(n % 19 == 0, ', "q": null').otherwise("")).alias("doc"))
    return left, right.union(right.where("o_orderkey % 31 = 0"))


AUDIT = """
WITH o AS (SELECT *, o_orderkey AS n FROM orders), both_ AS (SELECT * FROM o WHERE n % 23 <> 0 AND n % 29 <> 0 AND n % 31 <> 0),
f AS (
  SELECT n, '$' AS path, 'missing left' AS problem FROM o WHERE n % 23 = 0 AND n % 29 <> 0
  UNION ALL SELECT n, '$', 'missing right' FROM o WHERE n % 29 = 0 AND n % 23 <> 0
  UNION ALL SELECT n, '$', 'repeated right' FROM o WHERE n % 31 = 0 AND n % 23 <> 0 AND n % 29 <> 0
  UNION ALL SELECT n, '$.o_orderstatus', 'value' FROM both_ WHERE n % 7 = 0
  UNION ALL SELECT n, '$.of.o_custkey', 'value' FROM both_ WHERE n % 13 = 0
  UNION ALL SELECT n, '$.doc.p.list[1]', 'type' FROM both_ WHERE n % 11 = 0
  UNION ALL SELECT n, '$.doc.p.list[2]', 'only right' FROM both_ WHERE n % 17 = 0 AND n % 11 <> 0
  UNION ALL SELECT n, '$.doc.q', 'only right' FROM both_ WHERE n % 19 = 0)"""

_add("version_audit", "orders", lambda o: differences.audit(*_versions(o), ["o_orderkey"], ("doc",)).select("o_orderkey", "path", "problem"), AUDIT + " SELECT n AS o_orderkey, path, problem FROM f")

_add("first_difference", "orders", lambda o: differences.first_difference(differences.audit(*_versions(o), ["o_orderkey"], ("doc",)), ["o_orderkey"]),
     AUDIT + " SELECT n AS o_orderkey, arg_min(problem, path) AS problem, min(path) AS path, count(*) AS n FROM f GROUP BY 1")


def _split(o: DataFrame) -> DataFrame:
    """A tenth of the orders of every priority, by whole customers: what the chosen ones have, and the customers on both sides."""
    sizes = o.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    targets = {r.o_orderpriority: r.n // 10 for r in sizes.collect()}  # five priorities
    chosen = selection.choose_groups(o, "o_custkey", "o_orderpriority", targets).withColumn("chosen", F.lit(True))
    sides = o.join(chosen, "o_custkey", "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
    return sides.groupBy("o_orderpriority").agg(F.floor(F.count("*") / 10).alias("target"), F.count_if("chosen").alias("held"), (F.count("*") - F.count_if("chosen")).alias("left"))


_add("exact_group_split", "orders", _split, "SELECT o_orderpriority, count(*) // 10 AS target, count(*) // 10 AS held, count(*) - count(*) // 10 AS left FROM orders GROUP BY 1")


#: Batches of 32 orders by priority, in three types.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
TYPES = {name: dict(zip(PRIORITIES, of)) for name, of in (("a", (7, 7, 6, 6, 6)), ("b", (6, 6, 6, 7, 7)), ("c", (6, 7, 7, 6, 6)))}


def _batches(o: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """As many batches as the largest priority needs at six a batch, in types that take turns."""
    most = max((r.n for r in o.groupBy("o_orderpriority").agg(F.count("*").alias("n")).collect()), default=0)  # five priorities
    n = -(-most // 6)
    counts = {t: (n + 2 - i) // 3 for i, t in enumerate(sorted(TYPES))}
    return sampling.stratified(o, "o_orderkey", "o_orderpriority", TYPES, counts), counts


BATCHES = """
WITH o AS (SELECT o_orderkey, o_orderpriority AS stratum, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256('row/' || o_orderkey)) - 1 AS at_, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
b AS (SELECT (max(n) + 5) // 6 AS n FROM o),
tags AS (SELECT type, unnest(range(1, (n + 2 - i) // 3 + 1)) AS k FROM b, (VALUES ('a', 0), ('b', 1), ('c', 2)) t(type, i)),
batches AS (SELECT type, row_number() OVER (ORDER BY sha256('batch/' || type || '/' || k)) - 1 AS batch FROM tags),
quota(type, stratum, q) AS (VALUES """ + ", ".join(f"('{t}', '{s}', {q})" for t, of in TYPES.items() for s, q in of.items()) + """),
wide AS (SELECT batch, stratum, q, sum(q) OVER (PARTITION BY stratum ORDER BY batch) AS upto FROM batches JOIN quota USING (type)),
places AS (SELECT batch, stratum, unnest(range((upto - q)::BIGINT, upto::BIGINT)) AS place FROM wide),
put AS (SELECT batch, stratum, o_orderkey, (place >= n)::INT + 1 AS occurrence FROM places JOIN o USING (stratum) WHERE place = at_ OR place = at_ + n)
"""

_add("mixed_batches", "orders", lambda o: _batches(o)[0], BATCHES + """
SELECT batch, (row_number() OVER (PARTITION BY batch ORDER BY sha256('slot/' || batch || '/' || o_orderkey)) - 1)::INT AS slot, stratum, o_orderkey, occurrence FROM put""")


def _checked(o: DataFrame) -> DataFrame:
    """The schedule's own problems, none, beside those of one with a row left out, one moved and one put in again."""
    made, counts = _batches(o)
    first = F.col("o_orderkey") == F.lit(o.agg(F.min("o_orderkey")).head()[0])
    broken = made.where((F.col("batch") > 0) | (F.col("slot") > 0) | first).union(made.where((F.col("batch") == 1) & (F.col("slot") == 0)))
    audit = lambda s, name: sampling.stratified_problems(s, o, "o_orderkey", "o_orderpriority", TYPES, counts).select(F.lit(name).alias("schedule"), "problem")
    return audit(made, "made").union(audit(broken, "broken").where("problem IN ('twice in a batch', 'batch of no type')"))


_add("mixed_batches_audit", "orders", _checked, "SELECT 'broken' AS schedule, unnest(['twice in a batch', 'batch of no type']) AS problem")
