"""Vector, keyword and fused ranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceloom.operators.ranks import running
from traceloom.session import cut, small_side


def vector_topk(vectors: DataFrame, query_ids: tuple[int, ...], k: int = 10) -> DataFrame:
    """For a few stated query vectors, the ``k`` vectors of largest inner product, ties by id."""
    q = vectors.where(F.col("vec_id").isin(*query_ids)).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    dot = F.expr("aggregate(zip_with(q, embedding, (a, b) -> cast(a AS double) * b), 0D, (s, x) -> s + x)")
    scored = vectors.join(F.broadcast(q), F.col("vec_id") != F.col("query_id")).select("query_id", "vec_id", F.round(dot, 4).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def block_cells(vectors: DataFrame, is_query: Column, block: int = 1024, few: int = 4) -> DataFrame:
    """(queries, asked, ids, data): every block of queries beside every block of vectors, packed.

    Blocks are dealt ``few`` to a partition, on the average, and partitions meet
    each other, so what a task holds at once does not grow with the vectors.
    """

    def pack(batches):
        for b in batches:
            for lo in range(0, b.num_rows, block):
                ids, data = b.column(0).slice(lo, block), b.column(1).slice(lo, block).flatten()
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(ids).astype("<i8").tobytes()]), pa.array([np.asarray(data).astype("<f4").tobytes()])], ["ids", "data"])

    def packed(rows: DataFrame) -> DataFrame:
        rows = rows.where("embedding IS NOT NULL")
        blocks = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).mapInArrow(pack, "ids binary, data binary")
        return blocks.repartition(-(-rows.count() // (few * block)) or 1)

    return packed(vectors.where(is_query)).toDF("queries", "asked").hint("shuffle_replicate_nl").crossJoin(packed(vectors))


def vector_topk_of(vectors: DataFrame, is_query: Column, k: int = 10, block: int = 1024) -> DataFrame:
    """As ``vector_topk``, for every vector with ``is_query``: blocks of queries are scored against blocks of vectors.

    A pair of blocks gives the ``k`` best of each of its queries, by score to
    four places and then id; the last window ranks these. Vectors without an
    embedding are left out; all others have one length.
    """

    def score(batches):
        for b in batches:
            for n in range(b.num_rows):
                q, x, ids, data = (c[n].as_py() for c in b.columns)
                q, ids = np.frombuffer(q, "<i8"), np.frombuffer(ids, "<i8")
                x, y = (np.frombuffer(v, "<f4").reshape(len(n), -1).astype(np.float64) for n, v in ((q, x), (ids, data)))
                dots = np.floor(np.abs(x @ y.T) * 1e4 + 0.5) * np.sign(x @ y.T) / 1e4
                dots[q[:, None] == ids] = -np.inf
                order = np.lexsort((np.broadcast_to(ids, dots.shape), -dots), axis=1)[:, :k]
                best = np.take_along_axis(dots, order, 1)
                keep = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, keep.sum(1))), pa.array(ids[order][keep]), pa.array(best[keep])], ["query_id", "vec_id", "score"])

    found = block_cells(vectors, is_query, block).mapInArrow(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def tf(words: tuple[str, ...], text: str = "text") -> Column:
    """Sum of non-overlapping occurrences of each word in a lower-cased text."""
    low = F.lower(text)
    counts = [((F.length(low) - F.length(F.replace(low, F.lit(w), F.lit("")))) / len(w)).cast("long") for w in words]
    return sum(counts[1:], counts[0])


def keyword_tf(docs: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """(doc_id, tf) by ``tf``; documents without any of the words are left out."""
    return docs.select("doc_id", tf(words).alias("tf")).where("tf > 0")


def rrf(docs: DataFrame, first: tuple[str, ...], second: tuple[str, ...], weights=(1.5, 0.7), k: int = 60, least: float = 0.02) -> DataFrame:
    """Weighted reciprocal-rank fusion of two whole keyword rankings, with a threshold.

    Ranks are counted along ranges of (tf, doc_id), so no task holds a ranking
    or the many documents of one tf.
    """
    ranks, counts = [], cut(docs.select("doc_id", *(tf(words).alias(f"t{n}") for n, words in enumerate((first, second)))))  # texts are read once
    for n in range(2):
        found = counts.where(f"t{n} > 0").select((-F.col(f"t{n}")).alias("less"), "doc_id", F.lit(1).alias("one"))
        ranks.append(running(found, [], ["less", "doc_id"], "one").select("doc_id", (F.col("upto") - 1).alias(f"r{n}")))
    part = lambda n: F.coalesce(weights[n] / (k + F.col(f"r{n}") + 1), F.lit(0.0))
    both = ranks[0].join(ranks[1], "doc_id", "full")
    return both.select("doc_id", (part(0) + part(1)).alias("score")).where(F.col("score") >= least)


def by_place(customers: DataFrame, nations: DataFrame, regions: DataFrame, query: str) -> DataFrame:
    """Names found in the query: regions first, then nations; each with its customers."""
    places = nations.select(F.col("n_name").alias("place"), F.lit(2).alias("priority"), "n_nationkey").union(
        nations.join(small_side(regions), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", F.lit(1), "n_nationkey"))
    hit = places.where(F.lit(query).contains(F.col("place")))
    found = customers.join(small_side(hit), F.col("c_nationkey") == F.col("n_nationkey"))
    first = Window.partitionBy("c_custkey").orderBy("priority", "place")
    return found.withColumn("r", F.row_number().over(first)).where("r = 1").groupBy("place", "priority").agg(F.count("*").alias("n"))


def excerpts(docs: DataFrame, n: int = 3) -> DataFrame:
    """Of each source the first ``n`` distinct texts of 12 or more characters, compared whole, by hash, without case or repeated space."""
    line = F.trim(F.regexp_replace("text", r"\s+", " "))
    first = docs.select("source", "doc_id", line.alias("line")).where(F.length("line") >= 12).groupBy("source", F.sha2(F.lower("line"), 256).alias("excerpt_sha256")).agg(F.min("doc_id").alias("doc_id"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return first.withColumn("rank", rank).where(F.col("rank") <= n)
