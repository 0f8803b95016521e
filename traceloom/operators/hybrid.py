"""Search by place, vector and words over indexes: exact, with bounds that tell which cells need not be opened."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.operators.records import contained
from traceloom.session import shared_folder, small_side

#: Vectors that the cells' centres are fitted on, and rows of a part of a cell, which a task holds.
FIT_ROWS, PART_ROWS = 20_000, 50_000
BLOCK = 1024
HIT = "query_id long, id long, score double"


@dataclass
class Cells:
    """Centres of an index's cells, the greatest distance of a row from its cell's centre, and into how many parts a cell is cut."""

    centres: np.ndarray
    radius: np.ndarray
    parts: np.ndarray

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """No row of a cell has a larger inner product with a query than this (queries x cells)."""
        return q @ self.centres.T + np.linalg.norm(q, axis=1)[:, None] * self.radius


@dataclass
class VectorIndex:
    rows: DataFrame  # cell, part, id, v
    cells: Cells


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f4").reshape(len(raw), -1).astype(np.float64) if raw else np.zeros((0, 0))


def _packed(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([np.array(v, "<f4").tobytes() for v in b.column(1).to_pylist()], pa.binary())], ["id", "v"])

    return vectors.where(F.col(vector).isNotNull() & F.col(ident).isNotNull()).select(F.col(ident).cast("long"), F.col(vector).cast("array<float>")).mapInArrow(run, "id long, v binary")


def _centres(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres by a few rounds of k-means from evenly spaced rows; any centres give right results, good ones fewer open cells."""
    c = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        for k in np.unique(own):
            c[k] = x[own == k].mean(0)
    return c


def build_index(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", n_cells: int = 64, fit_rows: int = FIT_ROWS, part_rows: int = PART_ROWS) -> VectorIndex:
    """Every vector in the cell of its nearest centre, written by cell.

    Centres come from at most ``fit_rows`` vectors, those of least id hash; all
    vectors are indexed, and radii are those of all. Null vectors and ids are
    left out; the others have one length. A cell of many vectors, equal ones
    say, is cut into parts.
    """
    spark = vectors.sparkSession
    base = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    packed = _packed(vectors, ident, vector)
    sample = [bytes(r.v) for r in packed.orderBy(F.xxhash64("id", "v")).limit(fit_rows).collect()]
    centres = _centres(_matrix(sample), n_cells) if sample else np.zeros((1, 0))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        c = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                some = b.slice(lo, BLOCK)
                x = _matrix(some.column(1).to_pylist())
                cell = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
                far = np.linalg.norm(x - c[cell], axis=1) * (1 + 1e-9) + 1e-9
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cell, pa.int32()), pa.array(far)], ["id", "v", "cell", "far"])

    packed.mapInArrow(assign, "id long, v binary, cell int, far double").write.parquet(f"{base}/assigned")
    rows = spark.read.schema("id long, v binary, cell int, far double").parquet(f"{base}/assigned")
    radius, parts = np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
    for r in rows.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():  # one row a cell
        radius[r.cell], parts[r.cell] = r.far, -(-r.n // part_rows)
    cut_ = F.element_at(F.lit(parts.tolist()).cast("array<long>"), F.col("cell") + 1)
    return VectorIndex(rows.select("cell", F.pmod(F.xxhash64("id"), cut_).cast("int").alias("part"), "id", "v"), Cells(centres, np.where(np.isfinite(radius), radius, 0), parts))


def _scan(index: VectorIndex, asked: DataFrame, k: int) -> DataFrame:
    """HIT: the ``k`` best rows of each part for each query (cell, part, id, v) that opens it."""

    def best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        dots = q @ x.T
        score = np.floor(np.abs(dots) * 1e4 + 0.5) * np.sign(dots) / 1e4
        score[q_ids[:, None] == ids] = -np.inf
        order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
        top = np.take_along_axis(score, order, 1)
        keep = np.isfinite(top)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, keep.sum(1))), pa.array(ids[order][keep]), pa.array(top[keep])], ["query_id", "id", "score"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, ids, raw, x, waiting = None, [], [], None, []

        def flush():
            if waiting and ids:
                q = _matrix([v for _, v in waiting])
                for lo in range(0, len(waiting), 128):
                    yield best(np.array([i for i, _ in waiting[lo : lo + 128]], np.int64), q[lo : lo + 128], np.array(ids, np.int64), x)

        for b in batches:
            for cell, part, asks, i, v in zip(*(c.to_pylist() for c in b.columns)):
                if (cell, part) != at:
                    yield from flush()
                    at, ids, raw, x, waiting = (cell, part), [], [], None, []
                if not asks:
                    ids.append(i)
                    raw.append(v)
                    continue
                if x is None:
                    x, raw = _matrix(raw), []
                waiting.append((i, v))
                if len(waiting) == BLOCK:
                    yield from flush()
                    waiting.clear()
        yield from flush()

    both = index.rows.select("cell", "part", F.lit(False).alias("asks"), "id", "v").union(asked.select("cell", "part", F.lit(True), "id", "v"))
    return both.repartition("cell", "part").sortWithinPartitions("cell", "part", "asks").mapInArrow(run, HIT)


def _opened(queries: DataFrame, cells: Cells, probe: int, first: bool) -> DataFrame:
    """(cell, part, id, v) for the ``probe`` cells of each query's largest bounds, or for the others whose bound reaches ``least``."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        own = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                some = b.slice(lo, BLOCK)
                bounds = own.bounds(_matrix(some.column(1).to_pylist()))
                bounds[:, own.parts == 0] = -np.inf
                rank = np.argsort(np.argsort(-bounds, axis=1, kind="stable"), axis=1, kind="stable")
                least = np.array([-np.inf if x is None else x for x in some.column(2).to_pylist()])[:, None]
                # Scores are rounded to four places, so a bound must miss the least one by more than that.
                open_ = (rank < probe) if first else (rank >= probe) & (bounds >= least - 1e-4)
                q, c = np.nonzero(open_ & np.isfinite(bounds))
                n = own.parts[c]
                part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = pa.array(np.repeat(q, n))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(c, n), pa.int32()), pa.array(part, pa.int32()), some.column(0).take(at), some.column(1).take(at)], ["cell", "part", "id", "v"])

    return queries.select("id", "v", "least").mapInArrow(run, "cell int, part int, id long, v binary")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vector_search(index: VectorIndex, queries: DataFrame, ident: str, vector: str, k: int, probe: int = 2) -> tuple[DataFrame, DataFrame]:
    """((query_id, id, score, rank) of the ``k`` best rows, (query_id, opened, cells)): exact, by score to four places and then id.

    First each query opens ``probe`` cells, which gives it a least score; then
    the cells whose bound reaches that score. A query is no hit of itself. Both
    results are read from the shared folder.
    """
    spark = queries.sparkSession
    base = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    asked = _packed(queries, ident, vector)
    some = _opened(asked.withColumn("least", F.lit(None).cast("double")), index.cells, probe, True)
    _ranked(_scan(index, some, k), k).write.parquet(f"{base}/first")
    first = spark.read.schema(HIT + ", rank int").parquet(f"{base}/first")
    least = first.groupBy("query_id").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("least")).withColumnRenamed("query_id", "id")
    _opened(asked.join(least, "id", "left"), index.cells, probe, False).write.parquet(f"{base}/more")
    more = spark.read.schema("cell int, part int, id long, v binary").parquet(f"{base}/more")
    hits = first.drop("rank").unionByName(_scan(index, more, k))
    full = int((index.cells.parts > 0).sum())
    cells = more.select("id", "cell").distinct().groupBy("id").agg(F.count("*").alias("n"))
    opened = asked.select("id").join(cells, "id", "left").select(F.col("id").alias("query_id"), (F.coalesce("n", F.lit(0)) + min(probe, full)).alias("opened"), F.lit(full).cast("long").alias("cells"))
    return _ranked(hits, k), opened


def postings(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(word, id, tf): words of lower-cased text, runs of letters and digits of any script; null texts have none."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return docs.select(F.col(ident).alias("id"), F.explode(words).alias("word")).groupBy("word", "id").agg(F.count("*").alias("tf"))


def word_search(index: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` rows with most occurrences of the query's words (query_id, word), ties by id."""
    hits = index.join(small_side(asked.distinct()), "word").where("id <> query_id").groupBy("query_id", "id").agg(F.sum("tf").cast("double").alias("score"))
    return _ranked(hits, k)


def fused(vector_hits: DataFrame, word_hits: DataFrame, weights: tuple[float, float] = (0.7, 1.5), k: int = 60, least: float = 0.0) -> DataFrame:
    """(query_id, id, score): weighted reciprocal ranks of both lists, of at least ``least``. A query with one empty list keeps the other's."""
    part = lambda df, w: df.select("query_id", "id", (F.lit(w) / (F.lit(k) + F.col("rank"))).alias("score"))
    both = part(vector_hits, weights[0]).unionByName(part(word_hits, weights[1]))
    return both.groupBy("query_id", "id").agg(F.sum("score").alias("score")).where(F.col("score") >= least)


def by_place(queries: DataFrame, docs: DataFrame, places: DataFrame, limit: int) -> DataFrame:
    """(query_id, id, place, rank): rows of the places (place, level) that a query's text names, those of lower level first, then by place and id.

    ``docs`` has (id, place). Each place gives its first ``limit`` rows by id,
    a row found by two places counts once.
    """
    named = contained(queries.select("query_id", "text"), "text", places, "place").select("query_id", F.col("name").alias("place")).join(places, "place")
    first = docs.join(small_side(places.select("place")), "place", "left_semi").withColumn("r", F.row_number().over(Window.partitionBy("place").orderBy("id"))).where(F.col("r") <= limit).drop("r")
    hits = named.join(first, "place").groupBy("query_id", "id").agg(F.min(F.struct("level", "place")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("at.level", "at.place", "id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= limit).select("query_id", "id", "at.place", "rank")


def search(queries: DataFrame, docs: DataFrame, places: DataFrame, index: VectorIndex, words: DataFrame, limit: int, weights: tuple[float, float] = (0.7, 1.5), least: float = 0.0) -> DataFrame:
    """(query_id, strategy, id, rank): up to ``limit`` rows of each query.

    ``queries`` has query_id, text, vector and words (an array). A query whose
    text names a place of which there are rows gets these, strategy
    ``location_priority``. Others get ``hybrid_fallback``: the ``3 * limit``
    best by vector and by words, fused, from ``least`` on.
    """
    local = by_place(queries, docs, places, limit)
    base = f"{shared_folder(queries.sparkSession)}/places-{uuid.uuid4().hex}"
    local.write.parquet(base)
    local = queries.sparkSession.read.schema("query_id long, id long, place string, rank int").parquet(base)
    rest = queries.join(local.select("query_id").distinct(), "query_id", "left_anti")
    near, _ = vector_search(index, rest, "query_id", "vector", 3 * limit)
    spoken = word_search(words, rest.select("query_id", F.explode("words").alias("word")), 3 * limit)
    # Sums of two terms do not depend on their order; ranks go by them to twelve places.
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), "id")
    hybrid = fused(near, spoken, weights, least=least).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return local.select("query_id", F.lit("location_priority").alias("strategy"), "id", "rank").unionByName(hybrid.select("query_id", F.lit("hybrid_fallback").alias("strategy"), "id", "rank"))
