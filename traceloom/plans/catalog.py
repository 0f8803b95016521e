"""All registered queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.functions import text
from traceloom.operators import arguments, audits, conversations, evaluation, evidence, retrieval, sampling
from traceloom.plans import contracts as contract_queries
from traceloom.plans import flows as flow_queries
from traceloom.plans import records as record_queries
from traceloom.plans import rules as rule_queries
from traceloom.plans import scores as score_queries
from traceloom.plans import search as search_queries
from traceloom.plans import worlds as world_queries
from traceloom.session import small_side, table
from traceloom.streaming import episodes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, query: Callable, sql: str | None, *tables: str) -> None:
    QUERIES[name] = lambda spark, d: query(*(table(spark, d, t) for t in tables))
    if sql:
        ORACLES[name] = sql




SEG = "WITH m AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS seg FROM conversations), s AS (SELECT conv_id, seg::BIGINT AS seg, count(*) AS n_messages, count(*) FILTER (role = 'assistant') AS n_assistant, sum(length(text))::BIGINT AS n_chars FROM m WHERE seg >= 1 GROUP BY 1, 2) "
_add("conversation_segments", conversations.segment_percentiles, SEG + ", p AS (SELECT conv_id, count(*) AS n_segments, sum(n_chars)::BIGINT AS n_chars FROM s GROUP BY 1) SELECT n_segments, count(*) AS n_conversations, quantile_disc(n_chars, 0.5) AS p50, quantile_disc(n_chars, 0.95) AS p95 FROM p GROUP BY 1", "conversations")
_add("segment_table", conversations.segments, SEG + "SELECT * FROM s", "conversations")
_add("segment_rounds", conversations.rounds, "WITH l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations), r AS (SELECT *, sum((b IS NULL OR b <> role)::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS round FROM l) SELECT conv_id, round, min(role) AS role, count(*) AS n_messages, min(turn) AS first_turn FROM r GROUP BY 1, 2", "conversations")
PRE = "WITH m AS (SELECT *, count(*) OVER o AS n_prior, sum(length(text)) OVER o AS chars, count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS n_assistant FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)), a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth FROM m WHERE role = 'assistant'), p AS (SELECT conv_id, nth, n_prior, chars::BIGINT AS chars, unnest(range(1, CASE WHEN nth = n_assistant AND n_assistant > 1 THEN 4 ELSE 2 END)) AS copy FROM a) "
_TOOL = "CASE WHEN role = 'user' AND turn > 0 AND conv_id % 3 < 2 THEN 'tool' ELSE role END"  # two of three conversations have tool messages
_add("training_prefixes", lambda c: conversations.training_prefixes(c.withColumn("role", F.expr(_TOOL))).select("conv_id", "nth", "copy", F.size("conversation").alias("n"), F.sha2(F.array_join(F.transform("conversation", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "|"), 256).alias("sha256")), f"""
WITH m AS (SELECT conv_id, turn, {_TOOL} AS role, text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n, count(*) FILTER (role = 'tool') OVER (PARTITION BY conv_id) AS tools, count(*) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS of FROM m),
e AS (SELECT conv_id, i, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS nth, of FROM p WHERE role = 'assistant' AND tools > 0 UNION ALL SELECT conv_id, i, 0, -1 FROM p WHERE i = n AND tools = 0),
x AS (SELECT conv_id, i, nth, unnest(range(1, CASE WHEN nth = of THEN 4 ELSE 2 END)) AS copy FROM e)
SELECT x.conv_id, nth::INT AS nth, copy::INT AS copy, x.i::INT AS n, sha256(string_agg(role || ':' || text, '|' ORDER BY p.i)) AS sha256 FROM x JOIN p ON x.conv_id = p.conv_id AND p.i <= x.i GROUP BY x.conv_id, nth, copy, x.i""", "conversations")
_add("prefix_expansion", conversations.prefixes, PRE + "SELECT * FROM p", "conversations")
_add("longest_prefix_dedupe", conversations.longest_prefix, PRE + "SELECT conv_id, n_prior, chars FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n_prior DESC, copy) AS r FROM p) WHERE r = 1", "conversations")
_add("history_cap", conversations.last_n, "WITH b AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id) - r AS position FROM b WHERE r <= 4", "conversations")
_add("assistant_spans", conversations.assistant_spans, "WITH m AS (SELECT *, sum(length(role) + length(text) + 3) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS upto, max(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS last FROM conversations) SELECT conv_id, turn, upto - length(text) - 1 AS start, upto - 1 AS stop, turn = last AS is_last FROM m WHERE role = 'assistant'", "conversations")
_add("structure_audit", conversations.order_audit, "WITH m AS (SELECT *, row_number() OVER w - 1 AS r, lag(role) OVER w AS b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), p AS (SELECT conv_id, bool_and(r = turn) AS c, bool_and(role <> 'system' OR r = 0) AS s, bool_and(b IS NULL OR b <> role) AS a FROM m GROUP BY 1), l AS (SELECT conv_id, 'contiguous' AS rule, c AS ok FROM p UNION ALL SELECT conv_id, 'system_first', s FROM p UNION ALL SELECT conv_id, 'alternating', a FROM p) SELECT rule, count(*) FILTER (ok) AS n_pass, count(*) FILTER (NOT ok) AS n_fail, min(conv_id) FILTER (NOT ok) AS first_fail FROM l GROUP BY 1", "conversations")

_add("slice_summary", evaluation.slice_summary, "SELECT bucket, event_type, count(*) AS n, count(*) FILTER (event_type <> 'error') AS n_ok, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM (SELECT user_id % 5 AS bucket, event_type, value FROM events) GROUP BY GROUPING SETS ((), (bucket), (event_type))", "events")
_add("micro_vs_macro_rate", evaluation.pooled_and_averaged, "WITH d AS (SELECT user_id, ts::DATE AS day, count(*) FILTER (event_type <> 'view') AS r, count(*) FILTER (event_type = 'purchase') AS c FROM events GROUP BY 1, 2) SELECT user_id, CASE WHEN sum(r) = 0 THEN 1.0 ELSE sum(c) / sum(r) END::DOUBLE AS pooled, avg(CASE WHEN r = 0 THEN 1.0 ELSE c / r END::DOUBLE) AS averaged, count(*) AS n_days FROM d GROUP BY 1", "events")
_add("cost_rollup", evaluation.cost_per_task, "SELECT l_orderkey, tokens_in, tokens_out, tokens_in * 2.5::DOUBLE / 1e6 + tokens_out * 10.0::DOUBLE / 1e6 AS cost FROM (SELECT l_orderkey, sum(l_quantity::BIGINT)::BIGINT AS tokens_in, count(*) AS tokens_out FROM lineitem GROUP BY 1)", "lineitem")
_add("metric_unpivot", evaluation.metrics_long, "WITH a AS (SELECT event_type, min(value) AS lo, max(value) AS hi, count(value)::DOUBLE AS n FROM events GROUP BY 1) SELECT event_type, 'min' AS metric, lo AS value FROM a UNION ALL SELECT event_type, 'max', hi FROM a UNION ALL SELECT event_type, 'count', n FROM a", "events")
_add("endpoint_validity", evaluation.endpoint_validity, "WITH h AS (SELECT user_id, ts::DATE AS day, count(DISTINCT hour(ts)) AS k, max(hour(ts)) - min(hour(ts)) + 1 AS span FROM events GROUP BY 1, 2) SELECT user_id, count(*) FILTER (k = span) AS n_valid, count(*) AS n_days FROM h GROUP BY 1", "events")
GATES = [("n", ">=", 100.0), ("error_rate", "<", 0.2), ("max_value", "<=", 50.0)]
_add("acceptance_gates", lambda e: evaluation.gates(e, GATES), "WITH m AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (event_type = 'error') / count(*) AS error_rate, max(value) AS max_value FROM events) SELECT 'n' AS metric, '>=' AS op, 100.0::DOUBLE AS bound, CASE WHEN n >= 100 THEN 'PASS' ELSE 'FAIL' END AS status FROM m UNION ALL SELECT 'error_rate', '<', 0.2, CASE WHEN error_rate < 0.2 THEN 'PASS' ELSE 'FAIL' END FROM m UNION ALL SELECT 'max_value', '<=', 50.0, CASE WHEN max_value <= 50 THEN 'PASS' ELSE 'FAIL' END FROM m", "events")


def _board(nation: DataFrame, region: DataFrame) -> DataFrame:
    board = nation.where("n_nationkey < 20").select((F.col("n_nationkey") + 1).cast("int").alias("id"), F.col("n_name").alias("run"), F.col("n_regionkey").alias("score"))
    runs = nation.where("n_nationkey >= 15").select(F.col("n_name").alias("run"), (F.col("n_nationkey") * 10).alias("score"))
    return evaluation.upsert(board, runs, "run", "score")


_add("leaderboard_upsert", _board, "WITH b AS (SELECT n_nationkey + 1 AS id, n_name AS run, n_regionkey AS score FROM nation WHERE n_nationkey < 20), r AS (SELECT n_name AS run, n_nationkey * 10 AS score FROM nation WHERE n_nationkey >= 15) SELECT id, run, coalesce(r.score, b.score) AS score FROM b LEFT JOIN r USING (run) UNION ALL SELECT (SELECT max(id) FROM b) + row_number() OVER (ORDER BY run) AS id, run, score FROM r WHERE run NOT IN (SELECT run FROM b)", "nation", "region")
_add("success_gated_reward", evaluation.gated_reward, "SELECT user_id, bool_or(event_type = 'purchase') AS goal, count(*) FILTER (event_type = 'error') AS u, CASE WHEN bool_or(event_type = 'purchase') THEN greatest(0.5, 1.5 - 0.2 * count(*) FILTER (event_type = 'error'))::DOUBLE ELSE 0.0 END AS reward FROM events GROUP BY 1", "events")
_add("difficulty_category", evaluation.difficulty, "WITH d AS (SELECT user_id, ts::DATE AS day, bool_or(event_type = 'purchase') AS won FROM events GROUP BY 1, 2) SELECT user_id, CASE WHEN bool_and(won) THEN 'solved' WHEN NOT bool_or(won) THEN 'unsolved' ELSE 'mixed' END AS category, count(*) AS attempts FROM d GROUP BY 1", "events")
_add("lcs_score", evaluation.lcs_credit, None, "events")

_add("evidence_atoms", evidence.atoms, "SELECT sha256(text) AS atom, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY 1 HAVING count(*) > 1", "documents")
_add("world_entries", evidence.world, "SELECT sha256(l_partkey || '/' || l_suppkey) AS key_sha256, arg_min(l_returnflag || '|' || l_linestatus, sha256(l_returnflag || '|' || l_linestatus)) AS result, count(DISTINCT l_returnflag || '|' || l_linestatus) AS n_results FROM lineitem GROUP BY 1", "lineitem")
_add("world_conflicts", evidence.conflicts, "WITH p AS (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) SELECT l_partkey, l_suppkey, count(*) AS variants, sum(n)::BIGINT AS n, string_agg(l_returnflag || ':' || n, ',' ORDER BY l_returnflag) AS occurrences FROM p GROUP BY 1, 2 HAVING count(*) > 1", "lineitem")
_add("layered_lookup", evidence.layered_lookup, "WITH o AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'sealed' WHEN 'MACHINERY' THEN 'cached' ELSE 'fallback' END AS kind, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_name ELSE 'none' END AS answer FROM orders LEFT JOIN customer ON o_custkey = c_custkey) SELECT kind, count(*) AS n, min(answer) AS least_answer FROM o GROUP BY 1", "orders", "customer", "nation")
_add("manifest_counts", evidence.manifest, "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority))", "orders")
_add("aggregate_digest", evidence.digest, "SELECT n_regionkey, sha256(string_agg(n_name || '|' || sha256(n_name), ';' ORDER BY n_name)) AS digest FROM nation GROUP BY 1", "nation")
_add("evidence_groups", evidence.evidence_groups, "WITH RECURSIVE k AS (SELECT doc_id, sha256(text) AS k FROM documents UNION ALL SELECT doc_id, source || ':' || n_chars FROM documents), roots AS (SELECT k, min(doc_id) AS root FROM k GROUP BY 1), e AS (SELECT doc_id AS a, root AS b FROM k JOIN roots USING (k) WHERE doc_id <> root UNION SELECT root, doc_id FROM k JOIN roots USING (k) WHERE doc_id <> root), walk AS (SELECT a AS node, b AS reach FROM e UNION SELECT w.node, e.b FROM walk w JOIN e ON w.reach = e.a), g AS (SELECT doc_id, least(doc_id, coalesce(min(reach), doc_id)) AS group_id FROM documents LEFT JOIN walk ON doc_id = node GROUP BY doc_id) SELECT group_id, count(*) AS n, max(doc_id) AS last FROM g GROUP BY 1", "documents")
_add("grouped_split", evidence.grouped_split, "SELECT CASE WHEN ('0x' || substr(sha256(text), 1, 4))::BIGINT % 100 < 10 THEN 'held_out' ELSE 'train' END AS side, lang, count(*) AS n, count(DISTINCT text) AS n_texts FROM documents GROUP BY 1, 2", "documents")
_add("split_leakage_check", evidence.leakage, "SELECT sha256(text) AS atom FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT sha256(text) FROM documents WHERE doc_id % 2 = 1", "documents")
_add("coverage_matrix", evidence.coverage, "WITH s AS (SELECT DISTINCT user_id % 50 AS bucket, event_type, hour(ts)::INT AS hour FROM events) SELECT bucket, event_type, h::INT AS hour FROM (SELECT DISTINCT bucket FROM s), (SELECT DISTINCT event_type FROM s), range(24) r(h) EXCEPT SELECT * FROM s", "events")

DOT = "list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i]::DOUBLE * embedding[i]::DOUBLE))"
_add("vector_topk", lambda v: retrieval.vector_topk_of(v, F.col("vec_id") % 20 == 0), f"WITH s AS (SELECT x.vec_id AS query_id, e.vec_id, round({DOT}, 4) AS score FROM embeddings e, (SELECT vec_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0) x WHERE e.vec_id <> x.vec_id) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10", "embeddings")
_add("vector_topk_whole", lambda v: retrieval.vector_topk_of(v, F.col("vec_id") % 20 == 0), f"WITH s AS (SELECT x.vec_id AS query_id, e.vec_id, round({DOT}, 4) AS score FROM embeddings e, (SELECT vec_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0) x WHERE e.vec_id <> x.vec_id) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10", "embeddings")


def _tf(words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{w}', ''))) // {len(w)}" for w in words) + ")"


A, B = ("the", "and"), ("tion", "ing")
_add("keyword_tf", lambda d: retrieval.keyword_tf(d, A), f"SELECT doc_id, {_tf(A)}::BIGINT AS tf FROM documents WHERE {_tf(A)} > 0", "documents")
TOP = "SELECT doc_id, row_number() OVER (ORDER BY tf DESC, doc_id) - 1 AS {r} FROM (SELECT doc_id, {tf} AS tf FROM documents WHERE {tf} > 0)"
_add("rrf_fusion", lambda d: retrieval.rrf(d, A, B), f"WITH a AS ({TOP.format(r='r0', tf=_tf(A))}), b AS ({TOP.format(r='r1', tf=_tf(B))}), s AS (SELECT doc_id, coalesce(1.5::DOUBLE / (60 + r0 + 1), 0) + coalesce(0.7::DOUBLE / (60 + r1 + 1), 0) AS score FROM a FULL JOIN b USING (doc_id)) SELECT * FROM s WHERE score >= 0.02", "documents")
_add("location_priority", lambda c, n, r: retrieval.by_place(c, n, r, "trips in ASIA, FRANCE and CHINA"), "WITH p AS (SELECT n_name AS place, 2 AS priority, n_nationkey FROM nation UNION ALL SELECT r_name, 1, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey), h AS (SELECT * FROM p WHERE contains('trips in ASIA, FRANCE and CHINA', place)), f AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY priority, place) AS r FROM customer JOIN h ON c_nationkey = n_nationkey) SELECT place, priority, count(*) AS n FROM f WHERE r = 1 GROUP BY 1, 2", "customer", "nation", "region")
_add("distinct_excerpts", retrieval.excerpts, r"WITH f AS (SELECT source, sha256(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS excerpt_sha256, min(doc_id) AS doc_id FROM documents WHERE length(trim(regexp_replace(text, '\s+', ' ', 'g'))) >= 12 GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM f) WHERE rank <= 3", "documents")

_add("hash_permutation", sampling.permutation, "SELECT event_id, user_id % 64 AS bucket, row_number() OVER (PARTITION BY user_id % 64 ORDER BY sha256('s/' || event_id)) AS rank FROM events", "events")
_add("first_n_per_group", lambda o: sampling.first_n(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 7), "SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 7", "orders")
_add("quota_allocation", sampling.quotas, "WITH c AS (SELECT p_brand, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS a FROM part GROUP BY 1), x AS (SELECT p_brand, n * 1000 // a AS base, n * 1000 % a AS rest FROM c) SELECT p_brand, base + (row_number() OVER (ORDER BY rest DESC, p_brand) <= 1000 - sum(base) OVER ())::BIGINT AS quota FROM x", "part")
_add("anchor_sample_exact", sampling.anchors, "SELECT lang, toxic, doc_id, rank FROM (SELECT lang, toxic, doc_id, row_number() OVER (PARTITION BY lang, toxic ORDER BY sha256(doc_id::VARCHAR)) AS rank FROM documents JOIN labels USING (doc_id)) WHERE rank <= 5", "documents", "labels")
_add("batch_schedule", sampling.schedule, "WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY sha256(p_partkey::VARCHAR)) - 1 AS pos, count(*) OVER (PARTITION BY p_brand) AS n FROM part), a AS (SELECT p_brand, p_partkey, pos FROM r UNION ALL SELECT p_brand, p_partkey, pos + n FROM r WHERE pos < (32 - n % 32) % 32) SELECT p_brand, p_partkey, pos // 32 AS batch, pos % 32 AS slot FROM a", "part")


_add("price_extract", lambda d: d.select("doc_id", text.least_price("text").alias("price")), "SELECT doc_id, list_min(list_filter(list_transform(regexp_extract_all(text, '([0-9]{2,6})', 1), lambda x: x::INT), lambda x: x BETWEEN 30 AND 99999)) AS price FROM documents", "documents")
_add("rule_audit_long", text.rule_audit, r"WITH w AS (SELECT trim(text) <> '' AS a, NOT contains(text, '<') AS b, NOT regexp_matches(text, 'AKIA[A-Z0-9]{14,}') AS c, length(text) = n_chars AS d, NOT regexp_matches(text, '[a-z0-9.]+@[a-z0-9]+\.[a-z]{2,}') AS e FROM documents), l AS (SELECT 'not_blank' AS rule, a AS ok FROM w UNION ALL SELECT 'no_markup', b FROM w UNION ALL SELECT 'no_key', c FROM w UNION ALL SELECT 'length_is_right', d FROM w UNION ALL SELECT 'no_mail_address', e FROM w) SELECT rule, count(*) FILTER (coalesce(ok, false)) AS n_pass, count(*) FILTER (NOT coalesce(ok, false)) AS n_fail FROM l GROUP BY 1", "documents")
_add("date_surface_forms", lambda o: o.select("o_orderkey", F.array_join(text.date_forms(F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 12).cast("int")), F.to_date("o_orderdate")), "|").alias("forms")), "WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS t, o_orderdate::DATE + (o_orderkey % 12)::INT AS day, (o_orderkey % 12) AS n FROM orders) SELECT o_orderkey, concat_ws('|', strftime(day, '%Y-%m-%d'), month(day) || '/' || day(day), CASE n WHEN 1 THEN 'tomorrow' WHEN 2 THEN 'in two days' WHEN 3 THEN 'in three days' END, CASE date_diff('day', date_trunc('week', t), date_trunc('week', day)) WHEN 0 THEN 'this week' WHEN 7 THEN 'next week' END) AS forms FROM x", "orders")
_add("char_coverage", lambda n, r: n.join(small_side(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", F.round(text.char_coverage("r_name", "n_name"), 4).alias("coverage")), "SELECT n_name, round(len(list_intersect(list_distinct(string_split(lower(r_name), '')), list_distinct(string_split(lower(n_name), '')))) / len(list_distinct(string_split(lower(r_name), ''))), 4) AS coverage FROM nation JOIN region ON n_regionkey = r_regionkey", "nation", "region")
_add("episode_replay", episodes.replay, None, "events")
_add("session_rollup", episodes.session_rollup, "WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS n, max(value) AS top FROM s GROUP BY user_id, k", "events")

K = "TRY_CAST(json_extract_string(props, '$.k') AS INT)"
_add("typed_arguments", arguments.typed, f"SELECT event_id, {K} AS k, coalesce(json_extract_string(props, '$.note'), '') AS note, {K} IS NOT NULL AS ok FROM events", "events")
_add("argument_rules", arguments.schema_rules, f"WITH r AS (SELECT props IS NOT NULL AS o, len(list_filter(json_keys(props), lambda x: x <> 'k')) = 0 AS d, {K} BETWEEN 1 AND 30 AS i FROM events) SELECT 'object' AS rule, count(*) FILTER (o) AS n_pass, count(*) AS n FROM r UNION ALL SELECT 'declared', count(*) FILTER (d), count(*) FROM r UNION ALL SELECT 'in_range', count(*) FILTER (i), count(*) FROM r", "events")
_add("latest_binding", arguments.latest_binding, "WITH b AS (SELECT *, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bound FROM events) SELECT event_id, bound, CASE WHEN bound IS NULL THEN 'unbound' ELSE 'ok' END AS status FROM b WHERE event_type = 'purchase'", "events")
_add("slot_collisions", lambda e: arguments.slot_collisions(e, {"view": "seen", "click": "seen"}), "WITH s AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'seen' ELSE event_type END AS slot, count(DISTINCT value) AS v FROM events GROUP BY user_id, ts::DATE, 1) SELECT slot, count(*) AS n, max(v) AS most FROM s WHERE v > 1 GROUP BY 1", "events")
_add("template_render", arguments.customer_cards, "SELECT c_custkey, c_name || ' of ' || coalesce(n_name, '') || ': ' || c_mktsegment AS card FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey", "customer", "nation")
_add("seeded_fallback", arguments.seeded_values, "SELECT p_partkey, ('0x' || substr(sha256('f/' || p_partkey), 1, 8))::BIGINT % 97 AS value FROM part", "part")
_add("attempt_seeds", arguments.attempt_seeds, "SELECT p_partkey, a::INT AS attempt, 7 + p_partkey * 10000 + a * 100 AS seed FROM part, range(4) t(a)", "part")
_add("identity_fingerprint", arguments.fingerprints, "SELECT sha256(p_brand || '|' || p_size || '|' || p_type) AS fingerprint, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1", "part")

_add("one_to_one_audit", lambda d, l: audits.one_to_one(d, l, "doc_id"), "WITH a AS (SELECT doc_id, count(*) AS a FROM documents GROUP BY 1), b AS (SELECT doc_id, count(*) AS b FROM labels GROUP BY 1) SELECT CASE WHEN b IS NULL THEN 'only_left' WHEN a IS NULL THEN 'only_right' WHEN a > 1 OR b > 1 THEN 'repeated' ELSE 'matched' END AS status, count(*) AS n, min(doc_id) AS least_key FROM a FULL JOIN b USING (doc_id) GROUP BY 1", "documents", "labels")
_add("call_result_audit", audits.call_results, "WITH r AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, max(l_linenumber) AS top FROM lineitem GROUP BY 1) SELECT CASE WHEN l_orderkey IS NULL THEN 'no_result' WHEN o_orderkey IS NULL THEN 'no_call' WHEN d < n THEN 'repeated' WHEN top <> n THEN 'gap' ELSE 'ok' END AS status, count(*) AS n_calls FROM orders FULL JOIN r ON o_orderkey = l_orderkey GROUP BY 1", "orders", "lineitem")
_add("positional_outer_join", audits.by_position, "WITH r AS (SELECT l_orderkey, l_partkey, l_returnflag = 'R' AS side, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_linenumber, l_partkey) AS pos FROM lineitem), a AS (SELECT l_orderkey, pos, l_partkey AS returned FROM r WHERE side), b AS (SELECT l_orderkey, pos, l_partkey AS other FROM r WHERE NOT side) SELECT * FROM a FULL JOIN b USING (l_orderkey, pos)", "lineitem")
_add("set_equality", lambda l: audits.set_difference(l, "l_orderkey"), "WITH a AS (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R') SELECT side, count(*) AS n FROM (SELECT 'only_returned' AS side, x.* FROM (FROM a EXCEPT FROM b) x UNION ALL SELECT 'only_other', y.* FROM (FROM b EXCEPT FROM a) y) GROUP BY 1", "lineitem")
_add("single_result_check", audits.single_result, "SELECT l_partkey, l_suppkey, count(DISTINCT l_extendedprice) AS n_results FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_extendedprice) > 1", "lineitem")
POS = "p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events)"
_add("causal_path", audits.causal_path, f"WITH {POS}, s AS (SELECT *, event_type || '_' || lpad(pos::VARCHAR, greatest(2, length(pos::VARCHAR))::INT, '0') AS state FROM p) SELECT event_id, state, coalesce(lead(state) OVER (PARTITION BY user_id ORDER BY pos), 'end') AS next_state FROM s", "events")
_add("unbound_uses", audits.unbound_uses, f"WITH {POS}, f AS (SELECT user_id, min(pos) FILTER (event_type = 'view') AS f FROM p GROUP BY 1) SELECT user_id, count(*) FILTER (event_type = 'purchase') AS uses, count(*) FILTER (event_type = 'purchase' AND (f IS NULL OR pos < f)) AS unbound FROM p JOIN f USING (user_id) GROUP BY 1", "events")
_add("milestone_credit", audits.milestones, f"WITH {POS}, a AS (SELECT user_id, min(pos) FILTER (event_type = 'view') AS m FROM p GROUP BY 1), b AS (SELECT user_id, min(pos) FILTER (event_type = 'click' AND pos > m) AS m2 FROM p JOIN a USING (user_id) GROUP BY 1), c AS (SELECT user_id, min(pos) FILTER (event_type = 'purchase' AND pos > m2) AS m3 FROM p JOIN b USING (user_id) GROUP BY 1), k AS (SELECT user_id, (m IS NOT NULL)::BIGINT + (m2 IS NOT NULL)::BIGINT + (m3 IS NOT NULL)::BIGINT AS credited FROM a JOIN b USING (user_id) JOIN c USING (user_id)) SELECT user_id, credited, round(credited / 3, 6) AS ratio FROM k", "events")
_add("route_catalog", lambda e: audits.route_catalog(e, None), f"WITH {POS}, r AS (SELECT user_id, string_agg(event_type, '>' ORDER BY pos) AS route FROM p GROUP BY 1) SELECT route, count(*) AS n_users, min(user_id) AS least_user FROM r GROUP BY 1", "events")
_add("route_catalog_whole", lambda e: audits.route_catalog(e, None), f"WITH {POS}, r AS (SELECT user_id, string_agg(event_type, '>' ORDER BY pos) AS route FROM p GROUP BY 1) SELECT route, count(*) AS n_users, min(user_id) AS least_user FROM r GROUP BY 1", "events")
_add("run_lengths", audits.runs, f"WITH {POS}, i AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS g FROM p WHERE event_type = 'view') SELECT user_id, min(pos) AS first, max(pos) AS last FROM i GROUP BY user_id, g", "events")
FIELDS = ("l_discount", "l_linestatus", "l_quantity", "l_returnflag", "l_tax")
_add("first_differing_key", audits.first_differing, "SELECT a.l_orderkey, CASE " + " ".join(f"WHEN a.{f} IS DISTINCT FROM b.{f} THEN '{f}'" for f in FIELDS) + " END AS field FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_linenumber = 1 AND b.l_linenumber = 2", "lineitem")
_add("date_series", audits.date_series, "SELECT (o_orderdate::DATE + i::INT)::DATE AS day, count(*) AS n FROM orders, range(3) t(i) GROUP BY 1", "orders")
_add("topic_rotation", audits.topic_rotation, "SELECT o_orderkey, ['price', 'time', 'place'][(row_number() OVER (PARTITION BY o_orderpriority, o_orderdate::DATE ORDER BY o_orderkey) - 1) % 3 + 1] AS topic FROM orders", "orders")
_add("status_fold", audits.status_fold, "WITH d AS (SELECT CASE WHEN bool_or(event_type = 'error') THEN 'error' WHEN NOT bool_or(event_type = 'purchase') THEN 'empty' ELSE 'ok' END AS status FROM events GROUP BY user_id, ts::DATE) SELECT status, count(*) AS n FROM d GROUP BY 1", "events")
_add("training_rows", audits.training_rows, "WITH a AS (SELECT conv_id, flatten(list(list_transform(range(len(string_split(coalesce(text, ''), ' '))), lambda i: CASE WHEN role = 'assistant' THEN turn::INT ELSE -100 END) ORDER BY turn)) AS l FROM conversations GROUP BY 1), k AS (SELECT conv_id, len(l)::INT AS n_words, CASE WHEN len(l) > 64 THEN l[len(l) - 63:] ELSE l END AS l FROM a) SELECT conv_id, n_words, len(l)::INT AS n_kept, array_to_string(list_concat(l, list_transform(range((8 - len(l) % 8) % 8), lambda i: -100)), ',') AS labels FROM k", "conversations")

_add("place_stem", lambda n: n.select("n_name", text.stem(F.col("n_name"), ("IA", "AN", "E")).alias("stem"), F.expr("trim(TRAILING 'AEIN' FROM n_name)").alias("stripped")), "WITH a AS (SELECT n_name, CASE WHEN instr(n_name, 'IA') > 2 THEN left(n_name, instr(n_name, 'IA') - 1) ELSE n_name END AS x FROM nation), b AS (SELECT n_name, CASE WHEN instr(x, 'AN') > 2 THEN left(x, instr(x, 'AN') - 1) ELSE x END AS x FROM a) SELECT n_name, CASE WHEN instr(x, 'E') > 2 THEN left(x, instr(x, 'E') - 1) ELSE x END AS stem, rtrim(n_name, 'AEIN') AS stripped FROM b", "nation")
RATES = ("([0-9]+)/10", "([0-9][.][0-9])", "([0-9]+)")
_add("pattern_cascade", lambda d: d.select("doc_id", text.first_match("text", RATES).alias("found")), "SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}', 1)" for p in RATES) + " END AS found FROM documents", "documents")
TIERS = (("STEEL", "basic"), ("BRASS", "middle"), ("PROMO", "high"), ("1", "first"))
_add("tier_mapping", lambda p: p.groupBy(text.tier("p_type", TIERS).alias("tier")).agg(F.count("*").alias("n")), "SELECT CASE " + " ".join(f"WHEN contains(p_type, '{a}') THEN '{b}'" for a, b in TIERS) + " ELSE 'none' END AS tier, count(*) AS n FROM part GROUP BY 1", "part")
_add("block_strip", lambda p: p.select("page_id", F.sha2(text.without_block("html", "script"), 256).alias("digest")), "SELECT page_id, sha256(regexp_replace(html, '(?is)<script>.*?</script>', '', 'g')) AS digest FROM pages", "pages")
_add("plain_form_groups", lambda c: c.withColumn("text", F.element_at(F.split("text", " "), -1)).groupBy(F.sha2(text.plain_form("text"), 256).alias("form")).agg(F.count("*").alias("n")).where("n > 1"), r"SELECT sha256(regexp_replace(regexp_replace(string_split(text, ' ')[-1], '[ \t\n\r]+', '', 'g'), '[.!。！]+$', '')) AS form, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1", "conversations")
_add("dialogue_acts", lambda c: c.groupBy("role", text.dialogue_act("text").alias("act")).agg(F.count("*").alias("n"), F.count_if(text.meaningful("text")).alias("n_meaningful")), "SELECT role, CASE WHEN trim(coalesce(text, '')) = '' THEN 'invalid' WHEN regexp_matches(lower(text), 'cannot|unable|not able to') THEN 'refusal' WHEN contains(text, '?') THEN 'ask' ELSE 'final' END AS act, count(*) AS n, count(*) FILTER (length(replace(text, ' ', '')) >= 12 AND len(list_distinct(string_split(replace(text, ' ', ''), ''))) >= 4) AS n_meaningful FROM conversations GROUP BY 1, 2", "conversations")
_add("fenced_json", lambda e: e.withColumn("reply", F.concat(F.lit("so:\n```json\n"), "props", F.lit("\n```"))).select("event_id", F.get_json_object(text.fenced_json("reply"), "$.k").alias("k")), "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events", "events")


def _credit(events: DataFrame) -> DataFrame:
    n = {a: F.count_if(F.col("event_type") == t) for a, t in (("required", "view"), ("correct", "click"), ("extra", "error"))}
    per = events.groupBy("user_id").agg(*(c.alias(a) for a, c in n.items()))
    return per.select("user_id", F.round(text.gated_credit(F.least("correct", "required"), F.col("required"), F.col("extra")), 6).alias("reward"))


_add("segment_reward", _credit, "WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS r, count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'error') AS x FROM events GROUP BY 1) SELECT user_id, round(CASE WHEN r = 0 THEN (x = 0)::INT::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.8::DOUBLE * least(c, r) / r + (CASE WHEN x = 0 AND c >= r THEN 0.2::DOUBLE ELSE 0 END) - 0.1::DOUBLE * x)) END, 6) AS reward FROM c", "events")

for group in (record_queries, world_queries, score_queries, contract_queries, search_queries, flow_queries, rule_queries):
    QUERIES |= group.QUERIES
    ORACLES |= group.ORACLES
