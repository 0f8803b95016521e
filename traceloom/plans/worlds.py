"""Queries of worlds, replays, digests, quotas, grounding and promotion, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions import scalar
from traceloom.operators import records, sampling, worlds
from traceloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, tables: str, query: Callable, sql: str | None) -> None:
    QUERIES[name] = lambda spark, d: query(*(table(spark, d, t) for t in tables.split()))
    if sql:
        ORACLES[name] = sql


def _count(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


_add("route_estimates", "customer", lambda c: c.withColumn("km", scalar.fixed_km(F.col("c_acctbal") / 200, F.col("c_nationkey") * 3.0, F.lit(10.3), F.lit(20.7))).select(
    "c_custkey", scalar.far_route(F.col("km")).alias("f"), scalar.near_route(F.col("km") / 100).alias("t")).select(
    "c_custkey", F.col("f.transit_min").alias("far_transit"), "f.driving_min", "f.metres", "t.walking_min", "t.transit_min", F.col("t.fare").alias("near_fare")), """
WITH k AS (SELECT c_custkey, sqrt(power((c_nationkey * 3.0::DOUBLE - 20.7::DOUBLE) * 85.0::DOUBLE, 2) + power((c_acctbal / 200 - 10.3::DOUBLE) * 111.0::DOUBLE, 2)) AS km FROM customer),
m AS (SELECT c_custkey, km * 1.25::DOUBLE AS road, floor(km / 100 * 1000 * 1.3::DOUBLE)::BIGINT AS m FROM k)
SELECT c_custkey, floor(road / 150 * 60 + 40)::BIGINT AS far_transit, floor(road / 85 * 60)::BIGINT AS driving_min, floor(road * 1000)::BIGINT AS metres,
       greatest(1, m // 80) AS walking_min, greatest(5, m // 250 + 8) AS transit_min, (2 + m // 5000)::DOUBLE AS near_fare FROM m""")

_add("tree_digests", "customer", lambda c: worlds.tree_digests(c.select("c_nationkey", F.concat_ws("/", "c_mktsegment", "c_name").alias("path"), F.sha2("c_name", 256).alias("sha256"), F.length("c_name").cast("long").alias("size")), "c_nationkey"), """
WITH f AS (SELECT c_nationkey, c_mktsegment || '/' || c_name AS path, sha256(c_name) AS sha, length(c_name) AS size FROM customer)
SELECT c_nationkey, count(*) AS n_files, sum(size)::BIGINT AS bytes,
       sha256(unhex(string_agg(hex(encode(path)) || '00' || hex(encode(sha)) || '0A', '' ORDER BY path))) AS listed,
       sha256(unhex(string_agg(printf('%016x', strlen(path)) || hex(encode(path)) || sha, '' ORDER BY path))) AS framed,
       sha256('{"algorithm":"sha256-tree-v1","file_count":' || count(*) || ',"files":[' || string_agg('{"path":"' || path || '","sha256":"' || sha || '","size":' || size || '}', ',' ORDER BY path)
              || '],"total_bytes":' || sum(size)::BIGINT || '}') AS described FROM f GROUP BY 1""")

_add("named_files", "customer nation", lambda c, n: worlds.named_files(c.select("c_custkey", F.concat(F.lit("guides/"), "c_nationkey", F.when(F.col("c_custkey") % 7 > 0, F.lit("_")).otherwise(""), F.translate("c_name", "#", "_"), F.lit("_travel_guide.txt")).alias("file")), "file", n.where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("code"), "n_name"), "code").select("c_custkey", "code", "place", "n_name"), """
WITH b AS (SELECT c_custkey, c_nationkey || CASE WHEN c_custkey % 7 > 0 THEN '_' ELSE '' END || translate(c_name, '#', '_') AS base FROM customer),
p AS (SELECT c_custkey, split_part(base, '_', 1) AS code, substr(base, instr(base, '_') + 1) AS place FROM b WHERE contains(base, '_'))
SELECT c_custkey, code, place, n_name FROM p JOIN nation ON code = n_nationkey::VARCHAR WHERE n_regionkey < 3""")

_add("listed_names", "nation region", lambda n, r: worlds.listed_names(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("l")).select(F.format_string('{"%s": {"towns": ["%s"], "capital": "%s"}}', "r_name", F.array_join("l", '", "'), F.element_at("l", 1)).alias("j")), "j"),
     "SELECT r_name AS owner, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey")

_add("suspect_evidence", "customer nation", lambda c, n: worlds.suspects(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, " of INDIA").otherwise(" of CHINATOWN")).alias("name"), F.col("n_regionkey").alias("area"), F.col("c_mktsegment").alias("summary")), n.select(F.col("n_name").alias("place"), F.col("n_regionkey").alias("area")), "HOUSE|AUTO"), """
WITH h AS (SELECT c_custkey AS id, c_name || CASE WHEN c_custkey % 3 = 0 THEN ' of INDIA' ELSE ' of CHINATOWN' END AS name, n_regionkey AS area, c_mktsegment AS summary FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT id, regexp_matches(summary, 'HOUSE|AUTO') OR EXISTS (FROM nation WHERE contains(name, n_name) AND n_regionkey <> area) AS suspect FROM h""")

_add("plain_degrees", "lineitem", lambda l: l.select("l_orderkey", "l_linenumber", scalar.plain_degrees(F.concat(F.lit("今天大约 "), "l_linenumber", F.lit(" ~ "), F.col("l_quantity").cast("int"), F.lit("℃ 左右，夜里约"), F.col("l_partkey") % 9 - 5, F.lit("度，共约"), "l_linenumber", F.lit("人"))).alias("text")),
     "SELECT l_orderkey, l_linenumber, '今天' || l_linenumber || ' ~ ' || l_quantity::INT || '℃，夜里' || (l_partkey % 9 - 5) || '度，共约' || l_linenumber || '人' AS text FROM lineitem")

_add("planned_days", "documents", lambda d: d.select("doc_id", F.array_join(F.transform(scalar.planned_days(F.col("text"), [("the ", "The "), (" of ",), ("and",)]), lambda x: x.cast("string")), ",", "none").alias("days")), r"""
WITH p AS (SELECT doc_id, text, [greatest(instr(text, 'the '), instr(text, 'The ')), instr(text, ' of '), instr(text, 'and')] AS p FROM documents),
e AS (SELECT *, [least(CASE WHEN p[2] > p[1] THEN p[2] END, CASE WHEN p[3] > p[1] THEN p[3] END, length(text) + 1), least(CASE WHEN p[3] > p[2] THEN p[3] END, length(text) + 1), length(text) + 1] AS e FROM p)
SELECT doc_id, CASE WHEN text IS NULL THEN 'none,none,none' ELSE array_to_string([CASE WHEN p[i] = 0 THEN 'none' ELSE (length(regexp_replace(substr(text, p[i], e[i] - p[i]), '[\d℃°~\-\s，,。晴阴雨云多小中大雪雾雷]', '', 'g')) >= 25)::VARCHAR END FOR i IN [1, 2, 3]], ',') END AS days FROM e""")

_add("route_order", "orders", lambda o: worlds.order_routes(o.groupBy("o_custkey", "o_orderpriority").agg(F.array_sort(F.collect_list(F.col("o_orderkey") % 4)).alias("asks"), F.count_if(F.col("o_orderstatus") == "F").alias("tools"), F.count("*").alias("steps"), F.array_sort(F.collect_list(F.col("o_orderkey") % 7)).alias("labels")), "o_custkey", "o_orderpriority"), """
WITH r AS (SELECT o_custkey, o_orderpriority, list(o_orderkey % 4 ORDER BY o_orderkey % 4) AS asks, count(*) FILTER (o_orderstatus = 'F') AS tools, count(*) AS steps, list(o_orderkey % 7 ORDER BY o_orderkey % 7) AS labels FROM orders GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority, 'R-' || chr((64 + row_number() OVER (PARTITION BY o_custkey ORDER BY len(asks), asks, tools DESC, steps DESC, labels, o_orderpriority))::INT) AS tag FROM r""")

SCHEDULE = "r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY sha256(p_partkey::VARCHAR)) - 1 AS pos, count(*) OVER (PARTITION BY p_brand) AS n FROM part), s AS (SELECT p_brand, p_partkey, pos // 32 AS batch FROM (SELECT p_brand, p_partkey, pos FROM r UNION ALL SELECT p_brand, p_partkey, pos + n FROM r WHERE pos < (32 - n % 32) % 32))"
_add("schedule_audit", "part", lambda p: worlds.schedule_audit(sampling.schedule(p), p, "p_brand", "p_partkey", 32, 2), f"""
WITH {SCHEDULE}, b AS (SELECT count(*) AS n, count(DISTINCT p_partkey) AS d FROM s GROUP BY p_brand, batch), o AS (SELECT count(*) AS n FROM s GROUP BY p_partkey),
x AS (SELECT 'covers the sources' AS rule, (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM s)) AS bad
      UNION ALL SELECT 'occurrences', (SELECT count(*) FROM o WHERE n > 2) UNION ALL SELECT 'full batches', (SELECT count(*) FROM b WHERE n <> 32 OR d <> 32))
SELECT rule, bad, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM x""")

_add("sealed_world", "part", lambda p: _count(worlds.world_problems(p.select(F.col("p_partkey").alias("ordinal"), F.lpad(F.when(F.col("p_partkey") % 11 == 0, F.col("p_partkey") - 1).otherwise(F.col("p_partkey")).cast("string"), 9, "0").alias("key"), F.col("p_name").alias("result"), "p_size")
     .withColumn("key", F.when(F.col("ordinal") % 29 == 0, F.concat(F.lit("z"), "key")).otherwise(F.col("key"))).withColumn("key_sha256", F.when(F.col("p_size") > 3, F.sha2("key", 256))).withColumn("result_sha256", F.sha2(F.when(F.col("p_size") == 9, "other").otherwise(F.col("result")), 256))), "problem"), """
WITH e AS (SELECT p_partkey AS ordinal, CASE WHEN p_partkey % 29 = 0 THEN 'z' ELSE '' END || lpad(CASE WHEN p_partkey % 11 = 0 THEN p_partkey - 1 ELSE p_partkey END::VARCHAR, 9, '0') AS key, p_size FROM part)
SELECT problem, count(*) AS n FROM (
  SELECT 'key hash' AS problem FROM e WHERE p_size <= 3 UNION ALL SELECT 'result hash' FROM e WHERE p_size = 9
  UNION ALL SELECT 'repeated key' FROM (SELECT row_number() OVER (PARTITION BY key ORDER BY ordinal) AS i FROM e) WHERE i > 1
  UNION ALL SELECT 'order' FROM e JOIN e AS f ON f.ordinal = e.ordinal + 1 WHERE f.key < e.key) GROUP BY 1""")

_add("replay_determinism", "lineitem", lambda l: _count(worlds.determinism(l, ["l_partkey", "l_suppkey"], "l_returnflag"), "status", "replays"), """
SELECT status, replays, count(*) AS n FROM (SELECT count(*) AS replays, CASE WHEN count(*) < 2 THEN 'too few' WHEN count(DISTINCT l_returnflag) > 1 THEN 'differs' ELSE 'equal' END AS status FROM lineitem GROUP BY l_partkey, l_suppkey) GROUP BY 1, 2""")


def _replays(c: DataFrame) -> DataFrame:
    """Conversations with a system turn before them, against plans of two or three questions and an answer."""
    first = c.select("conv_id").distinct().select("conv_id", F.lit(-1).alias("turn"), F.lit("system").alias("role"), F.lit("be kind").alias("text"))
    every = c.where("role <> 'system'").select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text").unionByName(first)
    asks = F.array_repeat(F.lit("collect"), (F.col("conv_id") % 2 + 1).cast("int"))
    return worlds.replay_conversation(every, c.select("conv_id").distinct().select("conv_id", F.concat(asks, F.array(F.lit("respond"))).alias("actions")))


_add("conversation_replay", "conversations", _replays, """
WITH m AS (SELECT conv_id, role, trim(coalesce(text, '')) = '' AS blank, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations WHERE role <> 'system'),
c AS (SELECT DISTINCT conv_id FROM conversations),
w AS (SELECT conv_id, unnest(range(1, 4 + 2 * (conv_id % 2 + 1) - 1)) AS pos FROM c),
p AS (SELECT conv_id, pos, CASE WHEN w.pos IS NULL THEN 'goes on' WHEN m.pos IS NULL THEN 'ends early' WHEN role <> CASE WHEN pos % 2 = 1 THEN 'user' ELSE 'assistant' END THEN 'another role' WHEN blank THEN 'blank' END AS problem
      FROM (SELECT *, pos AS wpos FROM w) w FULL JOIN m USING (conv_id, pos))
SELECT conv_id, min(pos) FILTER (problem IS NOT NULL) AS position, arg_min(problem, pos) FILTER (problem IS NOT NULL) AS problem FROM p GROUP BY 1""")

_add("label_quota", "orders", lambda o: worlds.label_quota(o, "o_orderpriority", "o_orderstatus", "o_orderkey", {"F": (300, 29), "O": (30, 3), "P": (30, 3)}), """
SELECT o_orderpriority, o_orderstatus, o_orderkey, CASE WHEN rank <= CASE o_orderstatus WHEN 'F' THEN 29 ELSE 3 END THEN 'held_out' ELSE 'train' END AS side FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY sha256('quota:' || o_orderkey), o_orderkey) AS rank FROM orders WHERE o_orderstatus IN ('F', 'O', 'P'))
WHERE rank <= CASE o_orderstatus WHEN 'F' THEN 300 ELSE 30 END""")

_add("one_sided_entities", "orders", lambda o: worlds.one_sided(o.withColumn("side", F.when(F.col("o_orderkey") % 5 == 0, "held_out").otherwise("train")), "o_custkey", "side", ("train", "held_out")), """
SELECT o_custkey, CASE WHEN bool_and(o_orderkey % 5 = 0) THEN 'train' ELSE 'held_out' END AS missing FROM orders GROUP BY 1 HAVING bool_and(o_orderkey % 5 = 0) OR bool_and(o_orderkey % 5 <> 0)""")

_add("pass_rates", "events", lambda e: e.groupBy("event_type").agg(F.round(F.avg((F.col("value") > 10).cast("int")), 6).alias("goal_rate"), F.round(F.avg(F.get_json_object("props", "$.k").isNotNull().cast("int")), 6).alias("grounded_rate")),
     "SELECT event_type, round(avg((value > 10)::INT), 6) AS goal_rate, round(avg((json_extract_string(props, '$.k') IS NOT NULL)::INT), 6) AS grounded_rate FROM events GROUP BY 1")

_add("answer_rules", "documents", lambda d: _count(records.rule_table(d.where("text IS NOT NULL"), "doc_id", worlds.answer_rules(F.col("text"), F.array(F.lit("the"), F.lit("of")))), "rule", "status"), r"""
WITH r AS (SELECT length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) >= 24 AS a, len(regexp_extract_all(text, '(\S+)', 1)) >= 8 AS b, contains(text, 'the') AND contains(text, 'of') AS c FROM documents WHERE text IS NOT NULL)
SELECT rule, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n FROM (SELECT unnest(['letters', 'words', 'mentions']) AS rule, unnest([a, b, c]) AS ok FROM r) GROUP BY 1, 2""")

_add("ungrounded_facts", "documents labels", lambda d, l: worlds.ungrounded(d, "doc_id", "text", r"\b(\d{2,4})\b", l.select("doc_id", (F.col("doc_id") % 100).cast("string").alias("v")), "v"), r"""
SELECT d.doc_id, fact FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '\b(\d{2,4})\b', 1))) AS fact FROM documents) d
WHERE NOT EXISTS (FROM labels l WHERE l.doc_id = d.doc_id AND (l.doc_id % 100)::VARCHAR = fact)""")

_add("alias_codes", "customer nation", lambda c, n: worlds.canonical_codes(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit(" "), F.initcap("n_name")).alias("place")), "place", n.where("n_nationkey % 3 > 0").select("n_name", F.concat(F.lit("N"), "n_nationkey").alias("code")), "n_name", "code"), """
SELECT c_custkey, CASE WHEN n_nationkey % 3 > 0 THEN 'N' || n_nationkey ELSE ' ' || array_to_string(list_transform(string_split(n_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS place
FROM customer JOIN nation ON c_nationkey = n_nationkey""")


def _metrics(e: DataFrame) -> DataFrame:
    by = e.groupBy((F.col("user_id") % 40).alias("run")).agg(F.avg("value").alias("mean"), (F.count_if(F.col("event_type") == "error") / F.count("*")).alias("errors"))
    one = lambda name, higher: F.struct(F.lit(name).alias("metric"), F.round(name, 6).alias("value"), F.lit(higher).alias("higher_is_better"))
    long = by.select("run", F.explode(F.array(one("mean", True), one("errors", False))).alias("m"))
    return worlds.promotion(long.select(F.col("run").cast("string").alias("run"), "m.*").where("NOT (run = '7' AND metric = 'mean')"), "0", 0.05)


_add("promotion_gate", "events", _metrics, """
WITH m AS (SELECT (user_id % 40)::VARCHAR AS run, round(avg(value), 6) AS mean, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS errors FROM events GROUP BY 1),
f AS (SELECT a.run, (a.run = '7' OR NOT a.mean - b.mean >= -0.05::DOUBLE)::BIGINT + (NOT b.errors - a.errors >= -0.05::DOUBLE)::BIGINT AS failed FROM m a, m b WHERE b.run = '0' AND a.run <> '0')
SELECT run, failed, failed = 0 AS promoted FROM f""")

_add("exact_first", "customer nation", lambda c, n: worlds.exact_first(c.select(F.col("c_custkey").alias("query_id"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("n"), "c_nationkey")).otherwise("nothing").alias("query")), n.select(F.col("n_nationkey").alias("entry_id"), F.array(F.concat(F.lit("N"), "n_nationkey"), F.col("n_name")).alias("names")), c.select(F.col("c_custkey").alias("query_id"), F.explode(F.array(F.lit(3), F.lit(1))).alias("entry_id")).withColumn("rank", F.col("entry_id"))),
     "SELECT c_custkey AS query_id, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 1 END AS entry_id, CASE WHEN c_custkey % 2 = 0 THEN 'exact' ELSE 'ranked' END AS how FROM customer")

_add("probe_contract", "part", lambda p: _count(records.rule_table(p.select("p_partkey", F.col("p_partkey").cast("long").alias("position"), F.transform(F.sequence(F.lit(0), F.when(F.col("p_size") > 2, 3).otherwise(2)), lambda a: F.struct(a.alias("attempt"), (F.lit(7) + F.col("p_partkey") * 10_000 + a * F.when(F.col("p_size") == 20, 10).otherwise(100)).alias("seed"), (F.col("p_size") / 32).alias("reward"))).alias("attempts")), "p_partkey", worlds.probe_rules(4, 7)), "rule", "status"), """
SELECT rule, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n FROM (SELECT unnest(['attempts', 'seeds', 'rewards']) AS rule, unnest([p_size > 2, p_size <> 20, p_size / 32 <= 1.5]) AS ok FROM part) GROUP BY 1, 2""")

_add("bundle_check", "part", lambda p: _count(worlds.bundle(*(p.where(F.col("p_partkey") % m > 0).select(F.col("p_partkey").cast("string").alias("name"), F.sha2(F.concat("p_name", F.when(F.col("p_size") == m, "!").otherwise("")), 256).alias("sha256"), (F.length("p_name") + F.when(F.col("p_size") == 2 * m, 1).otherwise(0)).alias("bytes"), F.when(F.col("p_size") == 3 * m, None).otherwise(F.col("p_brand")).alias("role")) for m in (7, 11))), "status"), """
SELECT status, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'missing' WHEN p_partkey % 11 = 0 THEN 'extra' WHEN p_size IN (7, 11) THEN 'sha256' WHEN p_size IN (14, 22) THEN 'bytes' WHEN p_size IN (21, 33) THEN 'role' ELSE 'ok' END AS status
  FROM part WHERE p_partkey % 77 <> 0) GROUP BY 1""")
