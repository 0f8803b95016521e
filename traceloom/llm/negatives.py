"""Hard-negative mining by inner product, pruned in principal coordinates.

Vectors are rotated to the principal axes of a bounded sample, an orthogonal
change that keeps inner products. A block of anchors meets a block of rows by
partial products over leading components, a few more at a time; what the other
components can still add is bounded by the product of the residual norms, plus
a slack for rounding. Rows that cannot reach any of an anchor's windows are
discarded early, survivors are scored by integer products.

Anchors are a stated part of the rows and are held against all rows, block by
block: each goes to every part of the rows, never rows to rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import shared_folder, width

#: Rows that the rotation is fitted on, by least hash of their id.
FIT_ROWS = 10_000
#: Bytes of vectors in a part, which a task holds.
PART_BYTES = 32 << 20
#: Shape of a block of partial products.
ANCHORS, ROWS, STEP = 256, 4096, 16
#: Integers up to here are exact as doubles.
EXACT = 1 << 53
NONE = -(1 << 62)
VECTORS = "id long, label long, dim int, v binary"
FOUND = "anchor long, mark long, window int, score long, id long"


def clean(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """VECTORS of the rows that take part: components are floor(256 * x), as little-endian doubles.

    Left out are rows with a null id, label or vector, and with a null or
    non-finite component. Where the id is divisible by 7, the label is the next
    one modulo 10.
    """

    def run(batches):
        for b in batches:
            out = []
            for i, label, x in vec.rows([b], 1024):
                v = np.array(x, np.float64) if None not in x else np.full(1, np.nan)
                if np.isfinite(v).all():
                    v = np.floor(v * 256)
                    if v @ v >= EXACT:
                        raise ValueError(f"products of vector {i} are too large to be exact")
                    out.append((i, label, len(v), v.astype("<f8").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["id", "label", "dim", "v"])

    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull())
    return known.select(F.col("vec_id").cast("long"), label.alias("label"), F.col(vector).cast("array<double>")).mapInArrow(run, VECTORS)


def rotations(rows: DataFrame, fit_rows: int = FIT_ROWS) -> dict[int, np.ndarray]:
    """Of each vector length in the sample, the principal axes as columns, the longest first.

    Results do not depend on them; a length outside the sample keeps its axes.
    """
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(fit_rows).select("dim", "v").collect()
    out = {}
    for dim in {r.dim for r in sample if r.dim}:
        x = np.stack([np.frombuffer(r.v, "<f8") for r in sample if r.dim == dim])
        out[dim] = np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()
    return out


@dataclass
class Wanted:
    """Windows of a block of anchors: scores from ``low`` to ``high``, the best ``k`` of each; ``low`` rises with what is found."""

    low: np.ndarray  # anchors x windows
    high: np.ndarray
    k: int
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def add(self, a: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Exact scores of rows ``ids`` with anchors ``a``, which is ascending."""
        edges = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
        for lo, hi in zip(edges, edges[1:]):
            i, s, n = int(a[lo]), scores[lo:hi], ids[lo:hi]
            for w in range(self.low.shape[1]):
                fits = (s >= self.low[i, w]) & (s <= self.high[i, w])
                if not fits.any():
                    continue
                old = self.found.get((i, w), (s[:0], n[:0]))
                both, names = np.concatenate([old[0], s[fits]]), np.concatenate([old[1], n[fits]])
                best = np.lexsort((names, -both))[: self.k]
                self.found[i, w] = both[best], names[best]
                if len(best) == self.k:  # ties with the last one may still come by a smaller id
                    self.low[i, w] = max(self.low[i, w], both[best[-1]])


@dataclass
class Part:
    """Rows that anchors are held against, in their own and in principal coordinates."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    turned: np.ndarray
    rest: np.ndarray  # norms of the coordinates from 0, STEP, 2 * STEP, ...


def residuals(turned: np.ndarray) -> np.ndarray:
    """Norms of the coordinates from each multiple of STEP on, a little too large rather than too small."""
    squares = np.add.reduceat(turned**2, np.arange(0, max(turned.shape[1], 1), STEP), axis=1) if turned.shape[1] else np.zeros((len(turned), 1))
    return np.sqrt(squares[:, ::-1].cumsum(1)[:, ::-1]) * (1 + 1e-12)


def survivors(anchors: Part, rows: Part, want: Wanted, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) that may lie in a window: all that do, and few more.

    ``fits`` tells which pairs are asked for. Rows that no anchor needs leave
    the block, so the products stay dense.
    """
    dim = rows.turned.shape[1]
    low, high = np.where(want.low == NONE, -np.inf, want.low), want.high.astype(np.float64)
    slack = 64 * np.finfo(float).eps * max(dim, 1) * anchors.rest[:, :1] * rows.rest[:, 0].max(initial=0) + 1e-6
    left, partial = np.arange(len(rows.ids)), np.zeros(fits.shape)
    for step, lo in enumerate(range(0, dim, STEP)):
        hi = min(lo + STEP, dim)
        partial += anchors.turned[:, lo:hi] @ rows.turned[left, lo:hi].T
        more = anchors.rest[:, step + 1 : step + 2] * rows.rest[left, step + 1] + slack if hi < dim else slack
        top, bottom = partial + more, partial - more
        may = np.zeros(fits.shape, bool)
        for w in range(low.shape[1]):
            may |= (top >= low[:, w : w + 1]) & (bottom <= high[:, w : w + 1])
        fits = fits & may
        some = fits.any(0)
        if not some.all():
            left, partial, fits = left[some], partial[:, some], fits[:, some]
        if not len(left):
            break
    a, r = np.nonzero(fits)
    return a, left[r]


def search(anchors: Part, rows: Part, want: Wanted, same: bool) -> None:
    """Adds to ``want`` the rows of the anchors' own label (``same``) or of the others."""
    for lo in range(0, len(rows.ids), ROWS):
        some = Part(*(x[lo : lo + ROWS] for x in (rows.ids, rows.labels, rows.v, rows.turned, rows.rest)))
        fits = (anchors.labels[:, None] == some.labels) == same
        fits &= anchors.ids[:, None] != some.ids
        a, r = survivors(anchors, some, want, fits)
        if len(a) * 8 > fits.size:  # doubles hold these integers exactly, so the product of matrices is the integer one
            scores = (anchors.v @ some.v.T)[a, r]
        else:
            scores = np.concatenate([np.einsum("ij,ij->i", anchors.v[a[i : i + ROWS]], some.v[r[i : i + ROWS]]) for i in range(0, len(a), ROWS)] or [np.zeros(0)])
        want.add(a, scores.astype(np.int64), some.ids[r])


def turn(ids: list, labels: list, raw: list, dim: int, axes: dict[int, np.ndarray]) -> Part:
    v = np.frombuffer(b"".join(raw), "<f8").reshape(len(ids), dim)
    turned = v @ axes[dim] if dim in axes else v
    return Part(np.array(ids, np.int64), np.array(labels, np.int64), v, turned, residuals(turned))


def meet(rows: DataFrame, anchors: DataFrame, axes: dict[int, np.ndarray], k: int, same: bool) -> DataFrame:
    """FOUND: of each anchor, window and part the ``k`` best rows.

    ``rows`` are VECTORS with ``part``, ``anchors`` also with ``mark``, ``low``
    and ``high``, once for every part that they are held against. A part's rows
    come first in its task and are held, its anchors pass by in blocks.
    """
    shared = rows.sparkSession.sparkContext.broadcast(axes)

    def block(part: Part, anchors: list) -> pa.RecordBatch:
        ids, labels, raw, marks, low, high = zip(*anchors)
        n = max(map(len, low))
        pad = lambda x, with_: np.array([[*y, *[with_] * (n - len(y))] for y in x], np.int64).reshape(len(x), n)
        want = Wanted(pad(low, 1), pad(high, 0), k)  # an empty window where an anchor has fewer
        search(turn(ids, labels, raw, part.v.shape[1], shared.value), part, want, same)
        out = [(ids[i], marks[i], w, s, x) for (i, w), (ss, xs) in want.found.items() for s, x in zip(ss.tolist(), xs.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["anchor", "mark", "window", "score", "id"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, held, part, waiting = None, [], None, []
        for key, dim, is_anchor, i, label, v, mark, low, high in vec.rows(batches, 1024):
            if (key, dim) != at:
                if waiting and part is not None:
                    yield block(part, waiting)
                at, held, part, waiting = (key, dim), [], None, []
            if not is_anchor:
                held.append((i, label, v))
                continue
            if held:
                part, held = turn(*zip(*held), dim, shared.value), []
            waiting.append((i, label, v, mark, low, high))
            if len(waiting) == ANCHORS:
                if part is not None:
                    yield block(part, waiting)
                waiting = []
        if waiting and part is not None:
            yield block(part, waiting)

    none = F.lit(None)
    rows = rows.select("part", "dim", F.lit(False).alias("asks"), "id", "label", "v", none.cast("long").alias("mark"), *(none.cast("array<long>").alias(c) for c in ("low", "high")))
    both = rows.union(anchors.select("part", "dim", F.lit(True), "id", "label", "v", "mark", "low", "high"))
    return both.repartition("part", "dim").sortWithinPartitions("part", "dim", "asks").mapInArrow(vec.tidy(run), FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and window over all parts, with ``rank`` from 1."""
    order = Window.partitionBy("anchor", "mark", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, floor: int = 30, ceiling: int = 90, vector: str = "embedding", fit_rows: int = FIT_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Scores are integer inner products. An anchor's positives are its best
    ``positives`` rows of its label; negatives of a positive are the best
    ``negatives`` of the rows of other labels whose score lies from ``floor`` to
    ``ceiling`` hundredths of the positive's. Ties go by smaller id.

    Which rows take part is told in ``clean``. Vectors meet those of their own
    length; one whose squared length reaches 2**53 is an error, for its products
    would not be exact. Rows of an anchor's own id are no partners of it; other rows that
    repeat an id each count; an anchor that repeats whole is answered once. No
    rows, or no anchors, give no rows. ``is_anchor`` is a condition on vec_id.
    Only vec_id, label and the vector are read.
    """
    spark = vectors.sparkSession
    base = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    clean(vectors.select("vec_id", "label", vector), vector).write.parquet(f"{base}/rows")
    rows = spark.read.schema(VECTORS).parquet(f"{base}/rows")
    axes = rotations(rows, fit_rows)
    asks = rows.withColumn("vec_id", F.col("id")).where(is_anchor).drop("vec_id").distinct().withColumn("mark", F.xxhash64("label", "v"))

    # Own labels: parts of a label, as many as its size asks for.
    fits = F.greatest(F.lit(1), F.lit(part_bytes) / (8 * F.greatest("dim", F.lit(1))))
    sizes = rows.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / fits))
    sizes.write.parquet(f"{base}/sizes")
    sizes = spark.read.schema("label long, dim int, n long, parts long").parquet(f"{base}/sizes")
    sized = lambda df: df.join(sizes, ["label", "dim"])
    key = lambda p: F.xxhash64("label", p).alias("part")
    mine = sized(rows).select(*rows.columns, key(F.pmod(F.xxhash64("id"), "parts")))
    whole = F.array(F.lit(NONE)).alias("low"), F.array(F.lit(-NONE)).alias("high")
    asked = sized(asks).select(*asks.columns, *whole, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p")).withColumn("part", key("p"))
    found = best(meet(mine, asked, axes, positives, True), positives)
    found.select("anchor", "mark", "rank", "id", "score").write.parquet(f"{base}/positives")
    found = spark.read.schema("anchor long, mark long, rank int, id long, score long").parquet(f"{base}/positives")

    # Other labels: parts of all rows, each of which every anchor meets.
    # As many parts as there are partitions, while a part has some thousand rows.
    dealt = F.least(F.lit(width(spark)).cast("long"), F.ceil(F.col("n") / ROWS))
    total = sizes.groupBy("dim").agg(F.sum("n").alias("n")).select("dim", F.greatest(F.ceil(F.col("n") / fits), dealt).alias("parts"))
    share = lambda df: df.join(total, "dim")
    down = lambda x: f"((({x}) - pmod({x}, 100L)) div 100L)"  # noqa: E731  of a hundredth, in integers
    bounds = F.expr(f"-{down(f'-{floor}L * score')}").alias("low"), F.expr(down(f"{ceiling}L * score")).alias("high")
    window = F.sort_array(F.collect_list(F.struct("rank", *bounds)))
    windows = found.groupBy("anchor", "mark").agg(window.alias("w")).select(F.col("anchor").alias("id"), "mark", "w.low", "w.high")
    asked = share(asks.join(windows, ["id", "mark"])).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    against = share(rows).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    mined = best(meet(against, asked, axes, negatives, False), negatives).select("anchor", "mark", (F.col("window") + 1).alias("place"), F.col("rank").alias("n"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = found.withColumnRenamed("rank", "place").join(mined, ["anchor", "mark", "place"])
    return pairs.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("n").alias("rank"), "negative_id", F.col("score").alias("positive_score"), "negative_score")
