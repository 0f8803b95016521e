"""Packing by column generation over the histogram of piece lengths.

Documents become runs of token ids, cut only where they exceed a sequence. The
histogram of piece lengths, on a grid of ``grid`` tokens, has at most
``capacity / grid`` rows at any input size; a linear program over packing
patterns is solved on it, pricing new patterns by a knapsack dynamic program.
Rounded-down patterns plus a best-fit remainder give every length class its
slots, and pieces take slots by their rank in the class.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import cut, width

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Words kept by a Python worker between tasks. Beyond it they become the older half of the cache, from which
#: a word that occurs again comes back without being coded anew.
CACHE_WORDS = 500_000


class WordCoder:
    """Token ids of whole texts, coding each distinct word once.

    A text is cut at spaces and line feeds, across which the tokenizer neither
    normalises nor merges. Words that are not known go through the tokenizer as
    one pre-split list, so that normalising, splitting and merging are its own.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.words = words
        self.full = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.known) > self.words:
            self.known, self.older = {}, self.known
        new = {w for t in texts for w in t}.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        words = list(new - again)
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            coded = self.full.encode_batch([some], is_pretokenized=True, add_special_tokens=False)[0]
            edges = (np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(some) + 1)) * 4).tolist()
            raw = np.array(coded.ids, "<u4").tobytes()
            self.known.update((w, raw[a:z]) for w, a, z in zip(some, edges, edges[1:]))

    def code(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn(chunks)
        get = self.known.__getitem__
        return [b"".join(map(get, c)) for c in chunks]


def coder(path: str, words: int = CACHE_WORDS) -> WordCoder:
    return vec.keep((path, words), lambda: WordCoder(path, words))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, words: int = CACHE_WORDS) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of at most ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        own = coder(tokenizer, words)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for lo in range(0, len(ids), 512):
                out = []
                for doc, raw in zip(ids[lo : lo + 512], own.code([t or "" for t in texts.slice(lo, 512).to_pylist()])):
                    raw += end
                    n = len(raw) // 4
                    for s in range(0, n, capacity):
                        part = raw[4 * s : 4 * (s + capacity)]
                        out.append((doc, s, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(vec.tidy(run), PIECE_SCHEMA)


def price(values: np.ndarray) -> tuple[float, np.ndarray]:
    """Best multiset of classes (class i takes i + 1 units) within len(values) units: (value, counts)."""
    m = len(values)
    best, took = np.zeros(m + 1), np.zeros(m + 1, np.int64)
    for s in range(1, m + 1):
        with_last = best[s - 1 :: -1] + values[:s]  # last taken: class 0 to s - 1
        i = int(with_last.argmax())
        best[s], took[s] = (with_last[i], i + 1) if with_last[i] > best[s - 1] + 1e-12 else (best[s - 1], 0)
    counts, s = np.zeros(m, np.int64), m
    while s:
        if took[s]:
            counts[took[s] - 1] += 1
        s -= int(took[s]) or 1
    return float(best[m]), counts


def solve(demand: np.ndarray, gap: float = 1e-3, max_rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Patterns and fractional uses that cover ``demand`` with the fewest sequences.

    Revised simplex with an explicit inverse, columns priced by ``price``. It
    stops when no pattern is worth over 1 + ``gap``, or when the uses are within
    ``gap`` of the pieces' volume, so they are within ``gap`` of the optimum,
    well under what rounding costs. If it stops at
    ``max_rounds`` the basis is still feasible, only less tight.
    """
    classes = np.flatnonzero(demand)
    k, m = len(classes), len(demand)
    if not k:
        return []
    basis = np.zeros((k, k))
    basis[np.arange(k), np.arange(k)] = m // (classes + 1)
    inverse = np.diag(1 / basis.diagonal())
    use = demand[classes] / basis.diagonal()
    volume = demand @ np.arange(1, m + 1) / m
    for _ in range(max_rounds):
        if use.sum() <= (1 + gap) * volume:
            break
        dual = np.zeros(m)
        dual[classes] = np.maximum(inverse.sum(0), 0)
        value, counts = price(dual)
        if value <= 1 + gap:
            break
        column = counts[classes].astype(float)
        step = inverse @ column
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.full(k, np.inf)
        ratio[up] = use[up] / step[up]
        r = int(ratio.argmin())
        use = np.maximum(use - ratio[r] * step, 0)
        use[r] = ratio[r]
        inverse[r] /= step[r]
        others = step.copy()
        others[r] = 0
        inverse -= np.outer(others, inverse[r])
        basis[:, r] = column
    patterns = []
    for j in range(k):
        if use[j] > 0:
            p = np.zeros(m, np.int64)
            p[classes] = basis[:, j].astype(np.int64)
            patterns.append((p, float(use[j])))
    return patterns


def layout(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Whole patterns and how often each is used; together they hold exactly ``demand``."""
    m, left, uses = len(demand), demand.astype(np.int64).copy(), {}
    for p, x in solve(demand):
        held = p > 0
        n = min(int(x + 1e-6), int((left[held] // p[held]).min()))
        if n > 0:
            left -= n * p
            uses[tuple(p)] = uses.get(tuple(p), 0) + n
    while left.any():  # best fit, largest first, as often as the rest allows
        p, room = np.zeros(m, np.int64), m
        while room:
            fits = np.flatnonzero((left - p)[:room] > 0)
            if not len(fits):
                break
            c = int(fits[-1])
            n = min(room // (c + 1), int(left[c] - p[c]))
            p[c] += n
            room -= n * (c + 1)
        held = p > 0
        n = int((left[held] // p[held]).min())
        left -= n * p
        uses[tuple(p)] = uses.get(tuple(p), 0) + n
    return [(np.array(p), n) for p, n in sorted(uses.items(), reverse=True)]


def slots(plan: list[tuple[np.ndarray, int]], m: int) -> tuple[list[list[tuple[int, int, int, int]]], int]:
    """Of each class, ascending (first rank, copies a sequence, first sequence, place in it); and the number of sequences."""
    of: list[list[tuple[int, int, int, int]]] = [[] for _ in range(m)]
    seen, sequence = [0] * m, 0
    for p, n in plan:
        place = 0
        for c in np.flatnonzero(p)[::-1].tolist():
            k = int(p[c])
            of[c].append((seen[c], k, sequence, place))
            seen[c] += k * n
            place += k
        sequence += n
    return of, sequence


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, grid: int = 8, end_id: int = 1, rows_a_bucket: int = 50_000, words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Null text counts as empty and yields the one piece [end_id]. Repeated rows
    are packed as often as they occur; a null doc_id is kept. No documents give
    no pieces. Padding comes from the grid (under ``grid`` tokens a piece) and
    from at most a few hundred remainder sequences. Only doc_id and text are
    read. A worker holds ``words`` words, and as many again that it may yet
    need; fewer cost time, not pieces.
    """
    m = -(-capacity // grid)
    cutting = cut(pieces(docs, tokenizer, capacity, end_id, words)).withColumn("class", F.expr(f"cast((length + {grid - 1}) div {grid} - 1 AS int)"))
    demand = np.zeros(m, np.int64)
    for c, n in cutting.groupBy("class").count().collect():  # at most m rows
        demand[c] = n
    of, _ = slots(layout(demand), m)
    starts = [[x[0] for x in rows] for rows in of]

    @F.pandas_udf("sequence_id long, place long")
    def place(cls: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.empty((len(cls), 2), np.int64)
        for i, (c, r) in enumerate(zip(cls.tolist(), rank.tolist())):
            first, k, sequence, at = of[c][bisect_right(starts[c], r) - 1]
            more, rest = divmod(r - first, k)
            out[i] = sequence + more, at + rest
        return pd.DataFrame(out, columns=["sequence_id", "place"])

    # A class can hold most pieces, so it is dealt to at least as many buckets as there are partitions.
    buckets = max(width(docs.sparkSession), int(demand.sum()) // rows_a_bucket)
    dealt = cutting.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    sizes = dealt.groupBy("class", "bucket").count()
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("class", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "length", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(own) - 1).join(sizes, ["class", "bucket"])
    put = ranked.withColumn("at", place("class", F.col("rank") + F.col("base"))).select(*cutting.columns, "at.sequence_id", "at.place")
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return put.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
