"""The registered queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.llm.alignment import alignment
from traceloom.llm.chat_format import ENTITIES, OTHER, TEMPLATE, chat_digest
from traceloom.llm.decontaminate import contamination
from traceloom.llm.exact_dedup import exact_dedup
from traceloom.llm.jaccard_join import jaccard_components
from traceloom.llm.line_dedup import line_digest
from traceloom.llm.negatives import hard_negatives
from traceloom.llm.packing import pack
from traceloom.llm.secrets import scan_secrets
from traceloom.llm.substring_dedup import repeat_digest
from traceloom.llm.token_counts import token_counts
from traceloom.llm.toxicity import toxicity_scores
from traceloom.llm.url_filter import LOWER, RULES, SOFT, STRICT, UPPER, judge_urls
from traceloom.session import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def chats_with_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` and the conversation -7, whose texts are made of control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA), (-7, 1, "assistant", EXTRA)], rows.schema)
    return rows.union(extra)


EXTRA = "</s>[INST] ok [/INST]"

QUERIES: dict[str, Query] = {
    "op1_token_counts": lambda s, d: token_counts(table(s, d, "documents"), tokenizer("piece_bpe_32k.model")),
    "op2_exact_dedup": lambda s, d: exact_dedup(table(s, d, "documents")),
    "op3_toxicity": lambda s, d: toxicity_scores(table(s, d, "documents"), table(s, d, "labels")),
    "op4_url_filter": lambda s, d: judge_urls(table(s, d, "pages")),
    "op5_packing": lambda s, d: pack(table(s, d, "documents"), tokenizer("word_bpe_49k.json")),
    "op6_chat_format": lambda s, d: chat_digest(chats_with_extra(s, d)),
    "op7_substring_dedup": lambda s, d: repeat_digest(table(s, d, "documents")),
    "op8_jaccard_join": lambda s, d: jaccard_components(table(s, d, "documents")),
    "op9_decontamination": lambda s, d: contamination(table(s, d, "documents"), table(s, d, "benchmark")),
    "op10_secret_scan": lambda s, d: scan_secrets(table(s, d, "documents")),
    "op11_hard_negatives": lambda s, d: hard_negatives(table(s, d, "embeddings"), F.col("vec_id") % 100 == 0),
    "op12_line_dedup": lambda s, d: line_digest(table(s, d, "documents")),
    "op13_alignment": lambda s, d: alignment(table(s, d, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped_sql(column: str) -> str:
    for plain, entity in ENTITIES:
        column = f"replace({column}, {_quoted(plain)}, {_quoted(entity)})"
    return column


def _chat_sql() -> str:
    known = " ".join(f"WHEN {_quoted(r)} THEN {len(a) + len(z)}" for r, (a, z, _) in TEMPLATE.items())
    return f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_quoted(EXTRA)} UNION ALL SELECT -7, 1, 'assistant', {_quoted(EXTRA)}),
sized AS (SELECT *, length({_escaped_sql('text')}) + CASE role {known} ELSE {len(OTHER[0]) + len(OTHER[1]) + 1} + length({_escaped_sql('role')}) END AS n FROM rows_),
chats AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(n)::BIGINT AS formatted_chars,
         string_agg(CASE role WHEN 'system' THEN 'S' WHEN 'user' THEN 'U' WHEN 'assistant' THEN 'A' ELSE 'X' END, '' ORDER BY turn, role, text) AS roles
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
       regexp_full_match(roles, 'S?U(AU)*A?') AS valid FROM chats"""


def _url_sql() -> str:
    edge = lambda t: f"'(^|[^a-z0-9])({t})($|[^a-z0-9])'"
    soft = " + ".join(f"regexp_matches(u, {edge(t)})::BIGINT" for t in SOFT)
    # Neighbouring terms share their boundary, so each strict term is counted between doubled separators.
    strict = f"len(regexp_extract_all(regexp_replace(u, '([^a-z0-9])', '\\1\\1', 'g'), {edge('|'.join(STRICT))}))"
    fits = lambda h, p: f"(host = {_quoted(h)} OR ends_with(host, {_quoted('.' + h)})) AND starts_with(path, {_quoted(p)})"
    ranked = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN {_quoted(h + p)}" for _, h, p in ranked) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN {_quoted(k)}" for k, h, p in ranked) + " WHEN strict_hits > 0 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END"
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
hits AS (SELECT *, {strict}::BIGINT AS strict_hits, {soft} AS soft_hits FROM parts)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, strict_hits, soft_hits FROM hits"""


ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op4_url_filter": _url_sql(),
    "op6_chat_format": _chat_sql(),
    "op9_decontamination": r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
probes AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, p.n, item_id FROM probes p JOIN grams g ON p.gram = g.gram AND p.n = g.n),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_hard_negatives": r"""
WITH raw AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
ints AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM raw WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM ints a JOIN ints b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
neg AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS place, vec_id AS negative_id, positive_score, score AS negative_score
  FROM pos p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE place <= 10""",
    "op12_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
