"""Queries of search over indexes, with the full scan as their SQL.

A document's vector is the embedding of its number. Queries are the rows whose
id is divisible by 20: their own text, vector and three long words. Languages
serve as places, since some texts hold their short names as words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceloom.operators import hybrid
from traceloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DOT = "list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i]::DOUBLE * embedding[i]::DOUBLE))"
SCAN = f"""
SELECT query_id, vec_id AS id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM (SELECT x.vec_id AS query_id, e.vec_id, round({DOT}, 4) AS score FROM embeddings e, (SELECT vec_id, embedding AS q FROM embeddings WHERE vec_id % 20 = 0) x WHERE e.vec_id <> x.vec_id)"""


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return hybrid.vector_search(hybrid.build_index(v), v.where("vec_id % 20 = 0"), "vec_id", "embedding", 10)[0]


QUERIES["vector_cells"] = _vectors
ORACLES["vector_cells"] = f"SELECT query_id, id, score, rank::INTEGER AS rank FROM ({SCAN}) WHERE rank <= 10"


def _asked(spark: SparkSession, d: str) -> DataFrame:
    long = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]{8,})"), F.lit(1))))
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    # A third of the queries says one line, so that some name no place.
    text = F.when(F.col("doc_id") % 3 == 0, F.split_part("text", F.lit(" "), F.lit(1))).otherwise(F.col("text"))
    return table(spark, d, "documents").where("doc_id % 20 = 0").join(v, "doc_id").select(F.col("doc_id").alias("query_id"), text.alias("text"), "vector", F.slice(long, 1, 3).alias("words"))


def _hybrid(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    places = docs.select(F.col("lang").alias("place")).distinct().withColumn("level", F.when(F.col("place") == "en", 1).otherwise(2))
    index, words = hybrid.build_index(table(spark, d, "embeddings")), hybrid.postings(docs, "doc_id", "text")
    return hybrid.search(_asked(spark, d), docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("place")), places, index, words, 5, least=0.011)


QUERIES["hybrid_search"] = _hybrid
ORACLES["hybrid_search"] = rf"""
WITH asked AS (
  SELECT doc_id AS query_id, CASE WHEN doc_id % 3 = 0 THEN split_part(text, ' ', 1) ELSE text END AS text, list_sort(list_distinct(regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}]{{8,}})', 1)))[1:3] AS words
  FROM documents WHERE doc_id % 20 = 0 AND doc_id IN (SELECT vec_id FROM embeddings)),
places AS (SELECT DISTINCT lang AS place, CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS level FROM documents),
plain AS (SELECT query_id, ' ' || regexp_replace(lower(text), '[\x00-\x22\x24-\x2F\x3A-\x5E\x60\x7B-\x7F]+', ' ', 'g') || ' ' AS text FROM asked),
named AS (SELECT query_id, place, level FROM plain JOIN places ON regexp_matches(text, '(^|[^a-z0-9_#])' || place || '($|[^a-z0-9_#])')),
first AS (SELECT lang AS place, doc_id AS id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 5),
local AS (
  SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY min((level, place)), id) AS rank FROM named JOIN first USING (place) GROUP BY 1, 2 QUALIFY rank <= 5),
rest AS (SELECT * FROM asked WHERE query_id NOT IN (SELECT query_id FROM local)),
near AS (SELECT * FROM ({SCAN}) WHERE rank <= 15 AND query_id IN (SELECT query_id FROM rest)),
words AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}]+)', 1)) AS word FROM documents),
spoken AS (
  SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, id) AS rank FROM words JOIN (SELECT query_id, unnest(words) AS word FROM rest) USING (word) WHERE id <> query_id GROUP BY 1, 2 QUALIFY rank <= 15),
fused AS (
  SELECT query_id, id, round(sum(part), 12) AS score FROM (SELECT query_id, id, 0.7::DOUBLE / (60 + rank) AS part FROM near UNION ALL SELECT query_id, id, 1.5::DOUBLE / (60 + rank) FROM spoken) GROUP BY 1, 2 HAVING sum(part) >= 0.011)
SELECT query_id, 'location_priority' AS strategy, id, rank::INTEGER AS rank FROM local
UNION ALL SELECT query_id, 'hybrid_fallback', id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INTEGER AS rank FROM fused QUALIFY rank <= 5"""
