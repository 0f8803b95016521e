"""Queries of workflow graphs that Spark derives from the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceloom.operators import audits, flows, graph
from traceloom.session import small_side, table
from traceloom.streaming import capped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, tables: str, query: Callable, sql: str) -> None:
    QUERIES[name] = lambda spark, d: query(*(table(spark, d, t) for t in tables.split()))
    ORACLES[name] = sql


#: Rows that an edge needs. The rarest ways are left out, which leaves findings to the lint.
LEAST = 3


def _flow(o: DataFrame, l: DataFrame) -> DataFrame:
    """What an order goes through: start, priority, status, its lines' flags and their status; open lines go back to their order's status, as O."""
    both = o.join(l, F.col("o_orderkey") == F.col("l_orderkey"))
    flag = F.concat(F.lit("flag "), "l_returnflag")
    status = F.when((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderstatus") != "P"), F.concat(F.lit("is "), "o_orderstatus")).otherwise("is odd")
    ways = [
        (F.when(F.col("o_orderpriority").startswith("5"), "aside").otherwise("start"), F.col("o_orderpriority")), (F.col("o_orderpriority"), status), (status, flag),
        (flag, F.when(F.col("l_linestatus") == "O", "is O").otherwise("end")), (F.when(F.col("l_quantity") == 50, "end"), F.lit("after"))]
    steps = F.array(*(F.struct(a.alias("a"), b.alias("b")) for a, b in ways))
    return flows.seen_edges(both.select(F.explode(steps).alias("s")).select("s.a", "s.b"), LEAST)


FLOW = f"""
both_ AS (
  SELECT *, 'flag ' || l_returnflag AS flag, CASE WHEN o_orderkey % 2 = 0 OR o_orderstatus <> 'P' THEN 'is ' || o_orderstatus ELSE 'is odd' END AS st FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
pairs AS (
  SELECT CASE WHEN starts_with(o_orderpriority, '5') THEN 'aside' ELSE 'start' END AS a, o_orderpriority AS b FROM both_ UNION ALL SELECT o_orderpriority, st FROM both_ UNION ALL SELECT st, flag FROM both_
  UNION ALL SELECT flag, CASE WHEN l_linestatus = 'O' THEN 'is O' ELSE 'end' END FROM both_ UNION ALL SELECT 'end', 'after' FROM both_ WHERE l_quantity = 50),
e AS (SELECT row_number() OVER (ORDER BY a, b)::INT AS edge_id, a, b FROM (SELECT a, b FROM pairs GROUP BY 1, 2 HAVING count(*) >= {LEAST}))"""

_add("route_enumeration", "orders lineitem", lambda o, l: graph.routes(_flow(o, l).where("a NOT LIKE 'is%' OR b <> 'flag A'"), "start", ("end",)), f"""
WITH RECURSIVE {FLOW}, f AS (SELECT * FROM e WHERE a NOT LIKE 'is%' OR b <> 'flag A'),
w AS (SELECT 'start' AS node, []::INT[] AS path UNION ALL SELECT b, list_append(path, edge_id) FROM w JOIN f ON node = a WHERE NOT list_contains(path, edge_id))
SELECT node, len(path)::INT AS steps, array_to_string(path, '>') AS route FROM w WHERE node = 'end'""")

_add("reachability", "orders lineitem", lambda o, l: graph.reachable(_flow(o, l), "start"), f"""
WITH RECURSIVE {FLOW}, w AS (SELECT 'start' AS node, 0 AS steps UNION SELECT b, steps + 1 FROM w JOIN e ON node = a WHERE steps < 30) SELECT node, min(steps) AS steps FROM w GROUP BY 1""")

_add("graph_lint", "orders lineitem", lambda o, l: graph.lint(_flow(o, l), "start", ("end",)), f"""
WITH {FLOW} SELECT 'dead_end' AS finding, b AS node FROM e WHERE b NOT IN (SELECT a FROM e) AND b <> 'end' UNION SELECT 'unreached', a FROM e WHERE a NOT IN (SELECT b FROM e) AND a <> 'start' UNION SELECT 'terminal_goes_on', a FROM e WHERE a = 'end'""")

_add("branch_completeness", "orders lineitem", lambda o, l: audits.branch_gaps(_flow(o, l), ("start", "aside", "is F"), ("1-URGENT", "3-MEDIUM", "5-LOW", "flag R")), f"""
WITH {FLOW} SELECT tool, status, count(edge_id) AS n FROM (VALUES ('start'), ('aside'), ('is F')) t(tool), (VALUES ('1-URGENT'), ('3-MEDIUM'), ('5-LOW'), ('flag R')) u(status) LEFT JOIN e ON a = tool AND b = status GROUP BY 1, 2 HAVING count(edge_id) <> 1""")


def _nations(o: DataFrame, l: DataFrame, c: DataFrame, s: DataFrame) -> DataFrame:
    """Trade from a customer's nation to a larger supplier's; every 400th order goes back, which makes cycles."""
    c, s = small_side(c.select("c_custkey", "c_nationkey")), small_side(s.select("s_suppkey", "s_nationkey"))
    t = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).where("c_nationkey <> s_nationkey")
    low, high = F.least("c_nationkey", "s_nationkey"), F.greatest("c_nationkey", "s_nationkey")
    back = F.col("o_orderkey") % 400 == 0
    return t.select(F.when(back, high).otherwise(low).alias("a"), F.when(back, low).otherwise(high).alias("b"))


_add("cyclic_nations", "orders lineitem customer supplier", lambda o, l, c, s: flows.cyclic(_nations(o, l, c, s)), """
WITH RECURSIVE t AS (
  SELECT o_orderkey % 400 = 0 AS back, least(c_nationkey, s_nationkey) AS low, greatest(c_nationkey, s_nationkey) AS high
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey),
e AS (SELECT DISTINCT CASE WHEN back THEN high ELSE low END AS a, CASE WHEN back THEN low ELSE high END AS b FROM t),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), on_ AS (SELECT a AS node FROM r WHERE a = b),
nodes AS (SELECT a AS node FROM e UNION SELECT b FROM e)
SELECT node FROM nodes WHERE node IN (SELECT node FROM on_) OR (node IN (SELECT b FROM r WHERE a IN (SELECT node FROM on_)) AND node IN (SELECT a FROM r WHERE b IN (SELECT node FROM on_)))""")


def _continuity(e: DataFrame) -> DataFrame:
    """A user's day is a route of its events. Views give an item, clicks a choice, purchases need both; some users have an item from the start, some steps are broken off."""
    along = Window.partitionBy("route").orderBy("ts", "event_id")
    s = e.withColumn("route", F.concat_ws("/", "user_id", F.to_date("ts"))).withColumn("pos", F.row_number().over(along)).withColumn("next", F.coalesce(F.lead("event_type").over(along), F.lit("end")))
    steps = s.select("route", "pos", F.col("event_type").alias("a"), F.when(F.col("event_id") % 19 == 0, "lost").otherwise(F.col("next")).alias("b"))
    slot = F.when(F.col("event_type") == "view", "item").when(F.col("event_type") == "click", "choice")
    gives = s.select("route", "pos", slot.alias("slot")).where("slot IS NOT NULL")
    needs = s.where("event_type = 'purchase'").select("route", "pos", F.explode(F.array(F.lit("item"), F.lit("choice"))).alias("slot"))
    initial = s.where("user_id % 5 = 0").select("route", F.lit("item").alias("slot"))
    return flows.continuity(steps, gives, needs, initial, ("view", "click", "purchase", "signup"), ("end",))


_add("route_continuity", "events", _continuity, """
WITH s AS (
  SELECT *, user_id || '/' || ts::DATE AS route, row_number() OVER w::INT AS pos, coalesce(lead(event_type) OVER w, 'end') AS next, lag(event_id) OVER w AS before_id FROM events WINDOW w AS (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id)),
g AS (
  SELECT route, slot, pos, row_number() OVER (PARTITION BY route, slot ORDER BY pos) AS n FROM (
    SELECT route, pos, CASE event_type WHEN 'view' THEN 'item' ELSE 'choice' END AS slot FROM s WHERE event_type IN ('view', 'click') UNION ALL SELECT DISTINCT route, 0, 'item' FROM s WHERE user_id % 5 = 0)),
n AS (SELECT route, pos, unnest(['item', 'choice']) AS slot FROM s WHERE event_type = 'purchase')
SELECT route, pos, 'discontinuous' AS finding, event_type AS what FROM s WHERE before_id % 19 = 0
UNION ALL SELECT route, pos, 'starts elsewhere', event_type FROM s WHERE before_id IS NULL AND event_type = 'error'
UNION ALL SELECT route, pos, 'ends elsewhere', 'lost' FROM s WHERE next = 'end' AND event_id % 19 = 0
UNION ALL SELECT route, pos, 'given twice', slot FROM g WHERE n > 1
UNION ALL SELECT n.route, n.pos, 'unbound', n.slot FROM n LEFT JOIN g ON n.route = g.route AND n.slot = g.slot AND g.n = 1 WHERE g.pos IS NULL OR g.pos >= n.pos""".replace("row_number() OVER w::INT AS pos", "(row_number() OVER w)::INT AS pos"))


def _actions(e: DataFrame) -> DataFrame:
    """A user's day is an episode: sign-ups ask, the last event ends it, as a refusal if it is an error, the others are tools."""
    of = Window.partitionBy("episode").orderBy("ts", "event_id")
    s = e.withColumn("episode", F.concat_ws("/", "user_id", F.to_date("ts"))).withColumn("pos", F.struct("ts", "event_id"))
    last = F.lead("event_id").over(of).isNull()
    kind = F.when(last, F.when(F.col("event_type") == "error", "refusal").otherwise("final")).when(F.col("event_type") == "signup", "ask").otherwise("tool")
    return s.select("episode", "pos", kind.alias("kind"), F.col("event_type").alias("label"), F.when(F.col("event_type") == "error", "error").when(F.col("value") < 10, "empty").otherwise("ok").alias("status"))


ACTIONS = """
s AS (SELECT *, user_id || '/' || ts::DATE AS episode, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n FROM events WINDOW w AS (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id)),
k AS (
  SELECT *, CASE WHEN i = n THEN CASE WHEN event_type = 'error' THEN 'refusal' ELSE 'final' END WHEN event_type = 'signup' THEN 'ask' ELSE 'tool' END AS kind,
         CASE WHEN event_type = 'error' THEN 'error' WHEN value < 10 THEN 'empty' ELSE 'ok' END AS status, lpad(i::VARCHAR, greatest(2, length(i::VARCHAR))::INT, '0') AS nn FROM s),
t AS (SELECT *, kind || '_' || nn || CASE WHEN kind IN ('ask', 'tool') THEN '_' || event_type ELSE '' END AS state FROM k),
x AS (SELECT *, coalesce(lead(state) OVER v, 'done') AS next, lead(kind) OVER v AS after, max(state) FILTER (i = n) OVER (PARTITION BY episode) AS last FROM t WINDOW v AS (PARTITION BY episode ORDER BY i)),
y AS (SELECT *, CASE WHEN kind = 'tool' THEN CASE WHEN after = 'tool' THEN last ELSE next END END AS other FROM x)"""

_add("causal_graph", "events", lambda e: flows.causal_graph(_actions(e)).withColumn("milestones", F.array_join("milestones", ",")), f"""
WITH {ACTIONS}
SELECT episode, i::INT AS ordinal, state, next AS on_ok, other AS on_empty, other AS on_error,
       CASE kind WHEN 'ask' THEN state WHEN 'tool' THEN 'call_' || nn || '_' || event_type || '_01,round_' || nn || '_' || event_type || ',branch_' || nn || '_' || event_type || '_' || status ELSE 'valid_' || kind || '_' || nn END AS milestones FROM y""")


def _replayed(e: DataFrame) -> DataFrame:
    a = _actions(e)
    g = flows.causal_graph(a)
    along = Window.partitionBy("episode").orderBy("pos")
    named = a.withColumn("ordinal", F.row_number().over(along)).where("kind = 'tool'").join(g.select("episode", "ordinal", "state"), ["episode", "ordinal"])
    return flows.replay(g, named.select("episode", "state", "status"))


_add("path_replay", "events", _replayed, f"""
WITH RECURSIVE {ACTIONS}, w AS (SELECT DISTINCT episode, arg_min(state, i) OVER (PARTITION BY episode) AS state, 0 AS steps, '' AS last FROM y
  UNION ALL SELECT w.episode, CASE WHEN status <> 'ok' AND kind = 'tool' THEN other ELSE next END, steps + 1, y.state FROM w JOIN y ON w.episode = y.episode AND w.state = y.state)
SELECT episode, steps, last FROM w WHERE state = 'done'""")


def typed_actions(e: DataFrame) -> DataFrame:
    """Two users' events are an episode: sign-ups are a person's replies, views ask, clicks call tools, purchases end it; every other slot is an item."""
    kind = F.create_map(*map(F.lit, ("signup", "person", "view", "ask", "click", "tool", "purchase", "final")))[F.col("event_type")]
    return e.select(F.concat(F.lit("e"), F.floor(F.col("user_id") / 2)).alias("episode"), "ts", F.col("event_id").alias("seq"), F.coalesce(kind, F.lit("other")).alias("kind"), F.when(F.col("event_id") % 2 == 0, "item").when(F.col("event_id") % 3 == 0, "choice").otherwise("size").alias("slot"))


_add("capped_episodes", "events", lambda e: capped.ended(typed_actions(e.withColumn("user_id", F.col("user_id") * 40 + F.dayofyear("ts")))), """
WITH a AS (
  SELECT 'e' || (user_id * 40 + dayofyear(ts)) // 2 AS episode, ts, event_id, CASE event_type WHEN 'signup' THEN 'person' WHEN 'view' THEN 'ask' WHEN 'click' THEN 'tool' WHEN 'purchase' THEN 'final' ELSE 'other' END AS kind,
         (event_type = 'signup')::INT AS person, CASE WHEN event_id % 2 = 0 THEN 'item' WHEN event_id % 3 = 0 THEN 'choice' ELSE 'size' END AS slot FROM events),
b AS (
  SELECT *, sum(person) OVER w AS turns, sum(1 - person) OVER w AS rounds, row_number() OVER w AS pos, coalesce(max(person) OVER (PARTITION BY episode, slot ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS known
  FROM a WINDOW w AS (PARTITION BY episode ORDER BY ts, event_id)),
c AS (
  SELECT *, sum(1 - person) OVER (PARTITION BY episode, turns ORDER BY ts, event_id) AS in_turn, NOT CASE kind WHEN 'person' THEN true WHEN 'ask' THEN NOT known WHEN 'tool' THEN known WHEN 'final' THEN known ELSE false END AS wrong FROM b),
d AS (SELECT *, CASE WHEN kind = 'final' AND NOT wrong THEN 'done' WHEN rounds >= 24 THEN 'max_assistant_rounds' WHEN in_turn >= 6 THEN 'max_rounds_per_user_turn' WHEN turns >= 8 THEN 'max_person_turns' END AS outcome FROM c),
f AS (SELECT *, min(pos) FILTER (outcome IS NOT NULL) OVER (PARTITION BY episode) AS stop FROM d),
g AS (
  SELECT episode, arg_max(outcome, pos) AS outcome, max(rounds)::INT AS rounds, max(turns)::INT AS turns, count(*) FILTER (wrong) AS wrong, coalesce(string_agg(DISTINCT slot, ',' ORDER BY slot) FILTER (person = 1), '') AS slots FROM f WHERE pos <= stop GROUP BY 1),
h AS (SELECT *, (wrong + (outcome <> 'done')::INT)::INT AS violations FROM g)
SELECT episode, outcome, rounds, turns, violations, slots, CASE WHEN outcome = 'done' THEN greatest(0.5::DOUBLE, round(1.5::DOUBLE - 0.2::DOUBLE * violations, 6)) ELSE 0.0::DOUBLE END AS reward FROM h""")
