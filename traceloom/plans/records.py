"""Queries of record operators and scoring, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.functions import dialogue, scalar
from traceloom.operators import records, retrieval, scoring
from traceloom.session import cut, small_side, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, tables: str, query: Callable, sql: str | None) -> None:
    QUERIES[name] = lambda spark, d: query(*(table(spark, d, t) for t in tables.split()))
    if sql:
        ORACLES[name] = sql


def _day():
    return F.to_date("ts")


_add("registry_strip", "part", lambda p: records.strip_if_known(p.select("p_partkey", "p_name"), "p_name", " widget", p.where("p_size < 25").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w")), "w"), """
SELECT p_partkey, CASE WHEN ends_with(p_name, ' widget') AND left(p_name, length(p_name) - 7) IN (SELECT split_part(p_name, ' ', 1) FROM part WHERE p_size < 25)
                       THEN left(p_name, length(p_name) - 7) ELSE p_name END AS p_name FROM part""")

_add("closed_alias", "part", lambda p: p.groupBy(scalar.alias(F.col("p_type"), [("ECONOMY|SMALL|MEDIUM", "basic"), ("PROMO.*", "promo"), ("LARGE|STANDARD.*", "large")]).alias("kind"), scalar.keep_amount(F.col("p_brand"), r"Brand#(\d+)", "maker $1").alias("maker")).agg(F.count("*").alias("n")), r"""
SELECT CASE WHEN regexp_full_match(p_type, 'ECONOMY|SMALL|MEDIUM') THEN 'basic' WHEN regexp_full_match(p_type, 'PROMO.*') THEN 'promo'
            WHEN regexp_full_match(p_type, 'LARGE|STANDARD.*') THEN 'large' ELSE p_type END AS kind,
       regexp_replace(p_brand, '^Brand#(\d+)$', 'maker \1') AS maker, count(*) AS n FROM part GROUP BY 1, 2""")

_add("normalised_words", "conversations", lambda c: c.select("conv_id", "turn", F.array_join(scalar.normalise(F.split(scalar.normalise(F.col("text"), ("trim", "lowercase")), " "), ("sort_unique",)), " ").alias("words")),
     "SELECT conv_id, turn, array_to_string(list_sort(list_distinct(string_split(lower(trim(text)), ' '))), ' ') AS words FROM conversations")

_add("path_groups", "events", lambda e: e.groupBy(scalar.path_value(F.col("props"), "k").alias("k")).agg(F.count("*").alias("n")),
     "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")

_add("allow_list", "events", lambda e: e.where(F.col("event_type").isin("purchase", "signup")).select("event_id", "event_type"),
     "SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup')")

_add("budget_filter", "customer", lambda c: records.within_budget(c.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("price")), "c_nationkey", "price", 2000.0), """
WITH p AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS price FROM customer)
SELECT c_custkey, c_nationkey, price FROM (SELECT *, max(price) OVER (PARTITION BY c_nationkey) AS m FROM p) WHERE m IS NULL OR price IS NULL OR price <= 2000""")

LABEL = "split_part(split_part(url, '/', 3), '.', 1)"
_add("fail_closed", "pages", lambda p: p.withColumn("label", F.expr(LABEL)).where((F.trim("html") != "") & (F.lower("html").contains(F.col("label")) | F.col("label").contains(F.lower("html")))).select("page_id"),
     f"SELECT page_id FROM pages WHERE trim(html) <> '' AND (contains(lower(html), {LABEL}) OR contains({LABEL}, lower(html)))")

_add("entity_gate", "supplier nation", lambda s, n: s.join(small_side(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.round(scalar.fixed_km(F.col("s_acctbal") / 500, F.col("s_suppkey") % 50, F.col("n_nationkey") * 1.0, F.col("n_regionkey") * 10.0), 3).alias("km"), ((F.col("n_regionkey") == 1) | (scalar.fixed_km(F.col("s_acctbal") / 500, F.col("s_suppkey") % 50, F.col("n_nationkey") * 1.0, F.col("n_regionkey") * 10.0) <= 900)).alias("ok")), """
SELECT s_suppkey, round(km, 3) AS km, n_regionkey = 1 OR km <= 900 AS ok FROM (
  SELECT s_suppkey, n_regionkey, sqrt(power((s_suppkey % 50 - n_regionkey * 10) * 85.0::DOUBLE, 2) + power((s_acctbal / 500 - n_nationkey) * 111.0::DOUBLE, 2)) AS km
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""")

_add("task_filter", "events", lambda e: e.withColumn("day", _day()).join(e.where("event_type = 'purchase'").select("user_id", _day().alias("day")).distinct(), ["user_id", "day"], "left_semi").select("event_id"),
     "SELECT event_id FROM events WHERE (user_id, ts::DATE) IN (SELECT user_id, ts::DATE FROM events WHERE event_type = 'purchase')")

_add("lenient_results", "orders lineitem", lambda o, l: o.join(l.where("l_linenumber = 1"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", F.col("l_partkey").alias("result")),
     "SELECT o_orderkey, l_partkey AS result FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1")

_add("missing_transcripts", "customer orders", lambda c, o: c.join(o.groupBy("o_custkey").agg(F.count("*").alias("n")), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "no transcript").alias("error")),
     "SELECT c_custkey, count(o_custkey) AS n, CASE WHEN count(o_custkey) = 0 THEN 'no transcript' END AS error FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")

_add("unknown_names", "part", lambda p: (q := p.withColumn("stem", F.regexp_replace(F.concat_ws(" ", "p_brand", "p_name"), " (widget|gadget)$", ""))).join(q.where("p_size < 5").select("stem").distinct(), "stem", "left_anti").select("p_partkey", "stem"), """
WITH s AS (SELECT p_partkey, p_size, regexp_replace(p_brand || ' ' || p_name, ' (widget|gadget)$', '') AS stem FROM part)
SELECT p_partkey, stem FROM s WHERE stem NOT IN (SELECT stem FROM s WHERE p_size < 5)""")

_add("containment_join", "documents part", lambda d, p: records.contained(d.select("doc_id", F.concat_ws(" ", "text", F.when(F.col("doc_id") % 3 == 0, "a small widget")).alias("body")), "body", p.where("p_size < 25"), "p_name").groupBy("name").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), r"""
WITH t AS (SELECT doc_id, ' ' || regexp_replace(lower(concat_ws(' ', text, CASE WHEN doc_id % 3 = 0 THEN 'a small widget' END)), '[^a-z0-9_#]+', ' ', 'g') || ' ' AS body FROM documents)
SELECT name, count(*) AS n, min(doc_id) AS first FROM t JOIN (SELECT DISTINCT p_name AS name FROM part WHERE p_size < 25) ON contains(body, ' ' || lower(name) || ' ') GROUP BY 1""")

_add("nearest_place", "supplier customer", lambda s, c: records.nearest(c.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 100).alias("lat"), (F.col("c_custkey") % 97 + 0.25).alias("lon")), s.select(F.col("s_suppkey").alias("place"), (F.col("s_acctbal") / 100).alias("plat"), (F.col("s_suppkey") % 89 + 0.5).alias("plon")), 50.0), """
WITH m AS (SELECT c_custkey AS id, s_suppkey AS place,
             round(sqrt(power((c_custkey % 97 + 0.25::DOUBLE - (s_suppkey % 89 + 0.5::DOUBLE)) * 85.0::DOUBLE, 2) + power((c_acctbal / 100 - s_acctbal / 100) * 111.0::DOUBLE, 2)), 6) AS km FROM customer, supplier)
SELECT id, place, km FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY km, place) AS r FROM m WHERE km <= 50) WHERE r = 1""")

USER = "SELECT user_id, count(*) FILTER (event_type = 'view') AS required, least(count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'view')) AS correct, count(*) FILTER (event_type = 'error') AS extra, bool_or(event_type = 'purchase') AS matched, max(value) AS latency FROM events GROUP BY 1"


def _scores(e: DataFrame, *by) -> DataFrame:
    n = lambda t: F.count_if(F.col("event_type") == t)
    return e.groupBy(*(by or ("user_id",))).agg(n("view").alias("required"), F.least(n("click"), n("view")).alias("correct"), n("error").alias("extra"), F.bool_or(F.col("event_type") == "purchase").alias("matched"), F.max("value").alias("latency"))


_add("overall_roll_up", "events", lambda e: records.roll_up(_scores(e)), f"""
SELECT count(*) AS n, round(avg(matched::INT), 4) AS trace_match, CASE WHEN sum(required) > 0 THEN round(sum(correct) / sum(required), 4) ELSE 1.0 END::DOUBLE AS toolcall_match,
       sum(required)::BIGINT AS required, sum(correct)::BIGINT AS correct, sum(extra)::BIGINT AS extra, quantile_disc(latency, 0.5) AS p50, quantile_disc(latency, 0.95) AS p95 FROM ({USER})""")

_add("score_evidence", "events", lambda e: _scores(e).select("user_id", F.round(F.col("correct") / F.greatest("required", F.lit(1)), 12).alias("claimed"), "correct", "required").select("user_id", (F.abs(F.col("claimed") - F.col("correct") / F.greatest("required", F.lit(1))) <= 1e-12).alias("holds")),
     f"SELECT user_id, abs(round(correct / greatest(required, 1), 12) - correct / greatest(required, 1)) <= 1e-12 AS holds FROM ({USER})")

_add("trajectory_reward", "events", lambda e: _scores(e, "user_id", _day().alias("day")).withColumn("r", F.when(F.col("required") == 0, 0.0).otherwise(F.col("correct") / F.col("required"))).groupBy("user_id").agg(F.round(F.avg("r"), 6).alias("reward")),
     f"SELECT user_id, round(avg(CASE WHEN required = 0 THEN 0.0::DOUBLE ELSE correct / required END), 6) AS reward FROM ({USER.replace('GROUP BY 1', 'GROUP BY 1, ts::DATE')}) GROUP BY 1")

_add("place_distribution", "customer", lambda c: c.groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(10),
     "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10")

_add("budget_ceiling", "documents", lambda d: d.select("doc_id", scalar.largest_amount(F.col("text")).alias("ceiling")),
     r"SELECT doc_id, list_max(list_filter(list_transform(regexp_extract_all(text, '(\d{1,9})', 1), lambda x: x::BIGINT), lambda x: x BETWEEN 30 AND 99999)) AS ceiling FROM documents")

_add("keyword_ranking", "documents", lambda d: retrieval.keyword_tf(d, ("the", "und")).orderBy(F.desc("tf"), "doc_id"),
     "SELECT * FROM (SELECT doc_id, (length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 + (length(lower(text)) - length(replace(lower(text), 'und', ''))) // 3 AS tf FROM documents) WHERE tf > 0")

_add("attribute_search", "customer", lambda c: c.where((F.col("c_mktsegment") == "BUILDING") & F.col("c_name").contains("7")).select("c_custkey"),
     "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name LIKE '%7%'")

_add("priority_sort", "orders", lambda o: o.select("o_orderkey", "o_custkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.when(F.col("o_orderpriority").startswith("1"), 0).otherwise(1), "o_orderkey")).alias("place")),
     "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE 1 END, o_orderkey)::INT AS place FROM orders")


def _route_budgets(o: DataFrame) -> DataFrame:
    routes = o.groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("route")).agg(F.count("*").alias("n"))
    return routes.select("status", "route", F.col("route").rlike("^[12]").alias("fails"), F.sum("n").over(Window.partitionBy("status")).alias("budget"))


_add("route_quotas", "orders", lambda o: records.quotas(_route_budgets(o), "status", "budget"), """
WITH r AS (SELECT o_orderstatus AS status, o_orderpriority AS route, regexp_matches(o_orderpriority, '^[12]') AS fails, sum(count(*)) OVER (PARTITION BY o_orderstatus)::BIGINT AS budget FROM orders GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN bool_and(fails) OVER g OR NOT bool_or(fails) OVER g THEN budget ELSE round_even(budget * CASE WHEN fails THEN 1 - 0.8::DOUBLE ELSE 0.8::DOUBLE END, 0)::BIGINT END AS kind,
             count(*) OVER (PARTITION BY status, fails) AS size, row_number() OVER (PARTITION BY status, fails ORDER BY route) AS i FROM r WINDOW g AS (PARTITION BY status)),
s AS (SELECT *, kind // size + (i <= kind % size)::INT AS share FROM k),
d AS (SELECT *, budget - sum(share) OVER (PARTITION BY status) AS drift, row_number() OVER (PARTITION BY status ORDER BY share DESC, route) AS most FROM s)
SELECT status, route, (share + CASE WHEN most = 1 THEN drift ELSE 0 END)::BIGINT AS share FROM d""")

REMAINDER = """
WITH c AS (SELECT {key} AS key, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT *, least({floor}, n) AS first, sum(n) OVER () AS total FROM c),
l AS (SELECT *, greatest(0, {target} - sum(first) OVER ()) AS room FROM f),
w AS (SELECT *, n * room // total AS whole, n * room % total AS rest FROM l),
r AS (SELECT *, room - sum(whole) OVER () AS over_, row_number() OVER (ORDER BY rest DESC, key) AS rank FROM w),
shares AS (SELECT key, least(first + whole + (rank <= over_)::INT, n)::BIGINT AS share FROM r) """
_shares = lambda o, floor: records.largest_remainder(o.groupBy(F.col("o_orderpriority").alias("key")).agg(F.count("*").alias("n")), "key", "n", 40, floor)
_add("anchor_shares_floor", "orders", lambda o: _shares(o, 10), REMAINDER.format(key="o_orderpriority", floor=10, target=40) + "SELECT * FROM shares")
_add("anchors_exact_target", "orders", lambda o: records.anchors(o.select(F.col("o_orderpriority").alias("key"), "o_orderkey"), "key", "o_orderkey", _shares(o, 0)), REMAINDER.format(key="o_orderpriority", floor=0, target=40) + """
SELECT key, o_orderkey FROM (SELECT o_orderpriority AS key, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256('anchor:' || o_orderkey)) AS place FROM orders) JOIN shares USING (key) WHERE place <= share""")

_add("partition_complete", "orders customer", lambda o, c: records.complete_partition(o.select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("part")), "part", c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key")), "key").groupBy("problem").agg(F.count("*").alias("n")), """
WITH s AS (SELECT o_custkey AS key, count(DISTINCT o_orderstatus) AS parts FROM orders GROUP BY 1), w AS (SELECT c_custkey AS key, 1 AS known FROM customer WHERE c_custkey % 2 = 0)
SELECT problem, count(*) AS n FROM (SELECT CASE WHEN parts IS NULL THEN 'missing' WHEN known IS NULL THEN 'unknown' WHEN parts > 1 THEN 'in several' END AS problem FROM w FULL JOIN s USING (key)) WHERE problem IS NOT NULL GROUP BY 1""")

_add("set_differences", "lineitem orders", lambda l, o: (a := l.where("l_returnflag = 'R'").select("l_orderkey").distinct()).exceptAll(b := o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))).select(F.lit("only_first").alias("side"), "l_orderkey").union(b.exceptAll(a).select(F.lit("only_second"), "l_orderkey")).groupBy("side").agg(F.count("*").alias("n")), """
WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT side, count(*) AS n FROM (SELECT 'only_first' AS side, x.k FROM (FROM a EXCEPT FROM b) x UNION ALL SELECT 'only_second', y.k FROM (FROM b EXCEPT FROM a) y) GROUP BY 1""")

_add("keyword_extract", "pages", lambda p: p.select("page_id", F.array_join(scalar.keywords(F.col("url"), ("http", "https", "com", "org")), " ").alias("keywords")),
     r"SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(url), '([a-z0-9]+)', 1), lambda w: length(w) > 1 AND w NOT IN ('http', 'https', 'com', 'org')))), ' ') AS keywords FROM pages")

_add("code_rewrite", "customer", lambda c: c.select("c_custkey", scalar.rewrite_codes(F.concat(F.lit("code "), F.col("c_custkey") % 7 + 110100, F.lit(" or "), F.col("c_custkey") % 7 + 1101000), {"110101": "110102", "110103": "110109"}).alias("text")), r"""
SELECT c_custkey, 'code ' || CASE c_custkey % 7 WHEN 1 THEN '110102' WHEN 3 THEN '110109' ELSE (c_custkey % 7 + 110100)::VARCHAR END || ' or ' || (c_custkey % 7 + 1101000) AS text FROM customer""")

_add("weather_labels", "lineitem", lambda l: l.groupBy(dialogue.weather(F.col("l_quantity").cast("int")).alias("label")).agg(F.count("*").alias("n")), f"""
WITH w(code, label) AS (VALUES {', '.join(f"({k}, '{v}')" for k, v in dialogue.WEATHER.items())})
SELECT coalesce(label, '未知') AS label, count(*) AS n FROM lineitem LEFT JOIN w ON l_quantity::INT = code GROUP BY 1""")

_add("message_flattening", "conversations", lambda c: records.flatten_messages(c).select("conv_id", F.sha2("flat", 256).alias("flat_sha256")),
     "SELECT conv_id, sha256(string_agg('[' || role || '] ' || coalesce(text, ''), chr(10) ORDER BY turn)) AS flat_sha256 FROM conversations GROUP BY 1")

_add("response_mask", "conversations", lambda c: records.response_mask(c, 512), """
SELECT conv_id, left(string_agg(repeat(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, len(list_filter(string_split(coalesce(text, ''), ' '), lambda w: w <> ''))), '' ORDER BY turn), 512) AS mask FROM conversations GROUP BY 1""")

_add("bounded_stays", "orders", lambda o: o.select("o_orderkey", scalar.bounded_stay(F.col("o_orderdate"), F.col("o_orderkey")).alias("s")).select("o_orderkey", "s.start", "s.nights", scalar.weekday(F.col("s.start")).alias("weekday")), """
SELECT o_orderkey, (o_orderdate::DATE + (3 + o_orderkey % 10)::INT)::DATE AS start, least(1 + (o_orderkey // 100) % 7, 13 - o_orderkey % 10)::BIGINT AS nights,
       dayname(o_orderdate::DATE + (3 + o_orderkey % 10)::INT) AS weekday FROM orders""")

_add("date_ranges", "orders", lambda o: o.select("o_orderkey", scalar.date_range(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" ~ "), F.date_format(F.date_add("o_orderdate", 4), "yyyy-MM-dd"))).otherwise(""))).alias("r")).select("o_orderkey", "r.*"),
     "SELECT o_orderkey, o_orderdate::DATE AS first, (o_orderdate::DATE + CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 0 END)::DATE AS last, CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 1 END::BIGINT AS days FROM orders")

_add("distances", "customer", lambda c: c.select("c_custkey", F.round(scalar.km(F.col("c_acctbal") / 200, F.col("c_nationkey") * 3.0, F.lit(10.0), F.lit(20.0)), 4).alias("km"), F.round(scalar.fixed_km(F.col("c_acctbal") / 200, F.col("c_nationkey") * 3.0, F.lit(10.0), F.lit(20.0)), 4).alias("fixed_km")), """
SELECT c_custkey, round(111.0::DOUBLE * sqrt(power((n * 3.0::DOUBLE - 20) * cos(radians((lat + 10) / 2)), 2) + power(lat - 10, 2)), 4) AS km,
       round(sqrt(power((n * 3.0::DOUBLE - 20) * 85, 2) + power((lat - 10) * 111, 2)), 4) AS fixed_km FROM (SELECT c_custkey, c_acctbal / 200 AS lat, c_nationkey AS n FROM customer)""")

_add("trace_equality", "events", lambda e: records.same_trace(e, ("view", "click")), """
SELECT user_id, count(*) AS n, list(event_type ORDER BY ts, event_id) = ['view', 'click'] AS same FROM (SELECT *, min(ts::DATE) OVER (PARTITION BY user_id) AS first FROM events) WHERE ts::DATE = first GROUP BY 1""")

_add("single_flight", "events", lambda e: records.first_result(e, ["user_id", "event_type"], ["ts", "event_id"], "value"),
     "SELECT user_id, event_type, arg_min(value, (ts, event_id)) AS value, count(*) AS served FROM events GROUP BY 1, 2")

_add("retry_stage", "events", lambda e: records.retry_stage(e.withColumn("order", F.struct("ts", "event_id")), "user_id", "order", F.col("event_type") == "purchase", 4).groupBy("user_id").agg(F.count("*").alias("attempts"), F.bool_or("ok").alias("solved")), """
WITH t AS (SELECT user_id, event_type = 'purchase' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), x AS (SELECT *, max(ok::INT) FILTER (n <= 4) OVER (PARTITION BY user_id) AS early FROM t)
SELECT user_id, count(*) AS attempts, bool_or(ok) AS solved FROM x WHERE n <= 4 OR (early = 0 AND n <= 8) GROUP BY 1""")

_add("round_gate", "events", lambda e: records.gate(e.withColumn("day", _day()).withColumn("round", F.concat_ws("/", "user_id", "day")).withColumn("order", F.struct("ts", "event_id")), "round", "order", F.col("event_type") == "click", F.col("event_type") == "purchase").groupBy("user_id").agg(F.count_if("skipped").alias("skipped")), """
WITH g AS (SELECT user_id, event_type = 'purchase' AND coalesce(max((event_type = 'click')::INT) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS skipped FROM events)
SELECT user_id, count(*) FILTER (skipped) AS skipped FROM g GROUP BY 1""")

_add("transcript_quarantine", "orders", lambda o: records.quarantine(o, {"priced": F.col("o_totalprice") > 50000, "endpoint": F.col("o_orderstatus") != "P", "named": ~F.col("o_orderpriority").contains("NOT")}).groupBy("status", "broken").agg(F.count("*").alias("n")), """
WITH q AS (SELECT CASE WHEN NOT o_totalprice > 50000 THEN 'priced' WHEN o_orderstatus = 'P' THEN 'endpoint' WHEN contains(o_orderpriority, 'NOT') THEN 'named' END AS broken FROM orders)
SELECT CASE WHEN broken IS NULL THEN 'accepted' ELSE 'quarantined' END AS status, broken, count(*) AS n FROM q GROUP BY 1, 2""")

_add("record_rules", "lineitem", lambda l: records.rule_table(l.select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("line"), "*"), "line", {"quantity": F.col("l_quantity").between(1, 40), "discount": F.col("l_discount") < 0.08, "status": (F.col("l_linestatus") == "F") | (F.col("l_returnflag") == "N")}).groupBy("rule", "status").agg(F.count("*").alias("n")), """
SELECT rule, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS n FROM (
  SELECT unnest(['quantity', 'discount', 'status']) AS rule, unnest([l_quantity BETWEEN 1 AND 40, l_discount < 0.08, l_linestatus = 'F' OR l_returnflag = 'N']) AS ok FROM lineitem) GROUP BY 1, 2""")

_add("leaderboard_eligible", "events", lambda e: _scores(e).select("user_id", ((F.col("required") > 0) & (F.col("extra") == 0) & F.col("matched")).alias("eligible")),
     f"SELECT user_id, required > 0 AND extra = 0 AND matched AS eligible FROM ({USER})")

_add("progress_set", "customer orders", lambda c, o: records.pending(c.select(F.col("c_custkey").alias("key")), o.select(F.col("o_custkey").alias("key"), (F.col("o_orderstatus") == "F").alias("ok")), "key").groupBy("state").agg(F.count("*").alias("n")), """
SELECT state, count(*) AS n FROM (SELECT CASE WHEN count(o_custkey) = 0 THEN 'pending' WHEN bool_or(o_orderstatus = 'F') THEN 'done' ELSE 'failed' END AS state FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey) GROUP BY 1""")

_add("expansion_lineage", "lineitem orders", lambda l, o: l.join(o.where("o_totalprice > 100000"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy("l_returnflag").agg(F.count("*").alias("n")),
     "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000) GROUP BY 1")


def _endpoints(e: DataFrame) -> DataFrame:
    """A day's rounds are its distinct hours in order; it answers if its last event is a purchase, else it hit the cap."""
    of = Window.partitionBy("user_id", "day")
    r = e.withColumn("day", _day()).withColumn("round", F.dense_rank().over(of.orderBy(F.hour("ts"))))
    g = r.groupBy("user_id", "day").agg(F.max("round").alias("rounds"), F.array_sort(F.collect_set(F.when(F.col("event_type") != "purchase", F.col("round")))).alias("calls"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
    upto = lambda n: F.slice(F.sequence(F.lit(0), F.lit(40)), F.lit(2), n)
    answer = (F.col("last") == "purchase") & F.col("rounds").between(1, 6) & (F.col("calls") == upto(F.col("rounds") - 1))
    cap = (F.col("last") != "purchase") & (F.col("rounds") == 6) & (F.col("calls") == upto(F.lit(6)))
    return g.groupBy("user_id").agg(F.count_if(answer).alias("answers"), F.count_if(cap).alias("caps"), F.count("*").alias("days"))


_add("segment_endpoints", "events", _endpoints, """
WITH r AS (SELECT user_id, ts::DATE AS day, ts, event_id, event_type, dense_rank() OVER (PARTITION BY user_id, ts::DATE ORDER BY hour(ts)) AS round FROM events),
g AS (SELECT user_id, day, max(round) AS rounds, coalesce(list_sort(list(DISTINCT round) FILTER (event_type <> 'purchase')), []) AS calls, arg_max(event_type, (ts, event_id)) AS last FROM r GROUP BY 1, 2)
SELECT user_id, count(*) FILTER (last = 'purchase' AND rounds BETWEEN 1 AND 6 AND calls = range(1, rounds)) AS answers, count(*) FILTER (last <> 'purchase' AND rounds = 6 AND calls = range(1, 7)) AS caps, count(*) AS days FROM g GROUP BY 1""")

def _json_forms(e: DataFrame) -> DataFrame:
    """Texts with keys out of order, each held against one that is equal, equal but for a number's form, of another type, or longer."""
    k, n = F.get_json_object("props", "$.k"), F.col("event_id") % 4
    text = F.concat(F.lit('{"z": [1, {}], '), F.substr("props", F.lit(2)))
    other = F.concat(F.lit('{"k": '), F.when(n == 0, F.concat(k, F.lit(".0"))).when(n == 1, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k), F.lit(', "z": [1, {}'), F.when(n == 3, ", null").otherwise(""), F.lit("]}"))
    return e.select("event_id", scalar.canonical_json(text).alias("strict"), scalar.loose_json(text).alias("loose"), scalar.json_equal()(text, other).alias("equal"), scalar.json_equal(False)(text, other).alias("identical"))


_add("canonical_json", "events", _json_forms, """
SELECT event_id, '{"k":' || k || ',"z":[1,{}]}' AS strict, '{"k": ' || k || ', "z": [1, {}]}' AS loose, event_id % 4 IN (0, 2) AS equal, event_id % 4 = 2 AS identical
FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)""")


def _segments(e: DataFrame) -> DataFrame:
    """Required: the calls of a user's first day; made: those of the last, counted from its first."""
    w = Window.partitionBy("user_id")
    days = e.withColumn("day", _day()).withColumn("a", F.min("day").over(w)).withColumn("z", F.max("day").over(w))
    calls = lambda d: days.where(F.col("day") == F.col(d)).select("user_id", F.struct("ts", "event_id").alias("pos"), F.hour("ts").alias("round"), F.col("event_type").alias("tool"), F.col("props").alias("args"))
    both = cut(scoring.compared(calls("a"), calls("z"), ["user_id"]))
    reasons = scoring.details_of(both, ["user_id"]).groupBy("user_id").agg(F.array_sort(F.collect_list("reason")).alias("reasons"))
    return scoring.scores_of(both, ["user_id"]).join(reasons, "user_id")


_add("segment_match", "events", _segments, None)


def _rendered(e: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit("<tool_call>\n<function="), "event_type", F.lit(">\n<parameter=k>\n"), k, F.lit("\n</parameter>\n</function>\n</tool_call>"), F.when(F.col("event_id") % 5 == 0, "</tool_call").otherwise(""))
    line = F.concat(F.lit("<|tool_call_start|>["), "event_type", F.lit("(k="), k, F.lit(")]<|tool_call_end|>"), F.when(F.col("event_id") % 7 == 0, " and more").otherwise(""))
    p = e.select("event_id", "event_type", "props", scoring.tagged_calls(body).alias("x"), scoring.bracketed_calls()(line).alias("b"))
    want = F.array(F.struct(F.col("event_type").alias("tool"), F.concat(F.lit('{"k": "'), F.get_json_object("props", "$.k"), F.lit('"}')).alias("args")))
    first = lambda c: F.try_element_at(F.col(f"{c}.calls"), F.lit(1))
    return p.select("event_id", first("x")["tool"].alias("tool"), F.get_json_object(first("x")["args"], "$.k").alias("k"), F.col("x.malformed").alias("bad_tags"), F.get_json_object(first("b")["args"], "$.k").alias("bracket_k"), F.col("b.malformed").alias("bad_brackets"), F.round(scoring.emission_reward()(want, F.col("x.calls"), F.col("x.malformed")), 6).alias("reward"))


_add("parsed_calls", "events", _rendered, """
SELECT event_id, event_type AS tool, json_extract_string(props, '$.k') AS k, event_id % 5 = 0 AS bad_tags, json_extract_string(props, '$.k') AS bracket_k, event_id % 7 = 0 AS bad_brackets,
       CASE WHEN event_id % 5 = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS reward FROM events""")
