"""Substring dedup by fixed-block anchors.

Every document's non-overlapping blocks of ``block`` words, one at each multiple
of ``block + 1``, are the index; every rolling window of ``block`` words is a
probe. With ``block = size // 2`` any window of ``size`` words holds a whole
indexed block, so a window that two documents share makes a hit. Hits are
extended: the ``size``-word windows around them are compared across documents,
and runs of them are the maximal exact repeats.

Windows travel packed: one row carries a bucket's windows of many documents, as
32 bits of hash and a 16-bit step each. That is enough to find hits; the windows
of ``size`` words around them are compared by 96 bits of two independent hashes.

No window gathers its occurrences in one task, however many documents hold it.
A first pass tallies windows with a fixed number of counters (Misra and Gries);
what holds at least one in that number of all occurrences is frequent. Frequent
windows of ``block`` words are hits wherever they occur, which costs work and
changes nothing, since hits are verified. For frequent windows of ``size`` words
the least document is found by partial minima; that table, no longer than the
tally, is broadcast, and their occurrences are judged where they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import cut, small_side, width

COUNTERS = 1 << 18
BUCKET = 1 << 22  # windows of a task
BUCKETS = 1 << 15
PACKED = "bucket int, docs binary, counts binary, steps binary, hashes binary, proofs binary"
SEGMENT = 1 << 16


class Packer:
    """Collects (document, position, hash, proof) and emits them by bucket. A document longer than SEGMENT words is several.

    ``settled`` ones need no comparison: they go by document and without hashes.
    """

    def __init__(self, buckets: int, wide: bool, settled: bool = False, limit: int = 1 << 21):
        self.buckets, self.wide, self.settled, self.limit = buckets, wide, settled, limit
        self._begin()

    def _begin(self) -> None:
        self.docs, self.rows, self.at, self.hashes, self.proofs, self.held = [], [], [], [], [], 0

    def add(self, docs: np.ndarray, row: np.ndarray, at: np.ndarray, h: np.ndarray, proof: np.ndarray | None = None) -> None:
        """``row`` points into ``docs``; rows ascend and positions ascend within a row. Wide windows have a proof."""
        self.rows.append(row + sum(map(len, self.docs)))
        self.docs.append(docs)
        self.at.append(at)
        self.hashes.append(h)
        self.proofs.append(np.zeros(0, "<u4") if proof is None else (proof >> np.uint64(32)).astype("<u4"))
        self.held += len(h)

    def full(self) -> bool:
        return self.held >= self.limit

    def emit(self):
        if not self.held:
            return
        docs, row, at, h, proof = (np.concatenate(x) for x in (self.docs, self.rows, self.at, self.hashes, self.proofs))
        self._begin()
        seg, at = at // SEGMENT, at % SEGMENT
        key = vec.mix(docs[row].astype(np.uint64)) if self.settled else h & np.uint64(0xFFFFFFFF)
        to = (key % np.uint64(self.buckets)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[by], np.arange(self.buckets + 1))
        out = []
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = by[edges[k] : edges[k + 1]]
            piece = row[own] * (int(seg.max()) + 1) + seg[own]
            new = np.concatenate(([True], piece[1:] != piece[:-1]))
            first = np.flatnonzero(new)
            step = np.diff(at[own], prepend=0)
            step[first] = at[own][first]
            table = np.stack([docs[row[own][first]], seg[own][first]])
            value = h[own] if self.wide else (h[own] >> np.uint64(32)).astype("<u4")
            counts = np.diff(np.append(first, len(own)))
            seen = (b"", b"") if self.settled else (value.tobytes(), proof[own].tobytes() if self.wide else b"")
            out.append((k, table.tobytes(), counts.astype("<u4").tobytes(), step.astype("<u2").tobytes(), *seen))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] + [pa.binary()] * 5)], ["bucket", "docs", "counts", "steps", "hashes", "proofs"])


def unpack(batches, wide: bool) -> tuple[np.ndarray, ...]:
    """Documents, positions, hashes and proofs of a task's rows, then documents and positions of the settled ones."""
    none = np.zeros(0, np.int64)
    docs, ats, hs, proofs = ([none], [none]), ([none], [none]), [np.zeros(0, np.uint64 if wide else "<u4")], [np.zeros(0, "<u4")]
    for _, d, c, s, h, p in vec.rows(batches):
        table, counts = np.frombuffer(d, np.int64).reshape(2, -1), np.frombuffer(c, "<u4").astype(np.int64)
        step = np.frombuffer(s, "<u2").astype(np.int64)
        run = np.cumsum(step)
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        at = run - np.repeat(run[first] - step[first], counts)
        docs[not h].append(np.repeat(table[0], counts))
        ats[not h].append(at + np.repeat(table[1] * SEGMENT, counts))
        hs.append(np.frombuffer(h, np.uint64 if wide else "<u4"))
        proofs.append(np.frombuffer(p, "<u4"))
    return tuple(np.concatenate(x) for x in (docs[0], ats[0], hs, proofs, docs[1], ats[1]))


class Tally:
    """Counts of 64-bit values in ``keep`` counters at most. A count is never too high, and too low by at most total / keep."""

    def __init__(self, keep: int, limit: int = 1 << 20):
        self.keep, self.limit, self.total = keep, limit, 0
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts, self.held = [], 0

    def add(self, h: np.ndarray) -> None:
        self.parts.append(h)
        self.held += len(h)
        if self.held >= self.limit:
            self.fold()

    def fold(self) -> None:
        if self.held:
            new, n = np.unique(np.concatenate(self.parts), return_counts=True)
            total, self.parts, self.held = self.held, [], 0
            self.merge(new, n, total)

    def merge(self, values: np.ndarray, counts: np.ndarray, total: int) -> None:
        """Add the counters of another tally. The sum is as near as one tally of all would be."""
        self.total += total
        values, counts = np.concatenate([self.values, values]), np.concatenate([self.counts, counts])
        if not len(values):
            return
        by = np.argsort(values, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], values[by][1:] != values[by][:-1])))
        values, counts = values[by][first], np.add.reduceat(counts[by], first)
        if len(values) > self.keep:
            counts = counts - np.partition(counts, -self.keep - 1)[-self.keep - 1]
        self.values, self.counts = values[counts > 0], counts[counts > 0]

    def shares(self, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Values with at least one in ``keep`` of the total and a count of ``least``, and their counts."""
        own = (self.counts >= least) & (self.counts * self.keep >= self.total)
        return self.values[own], self.counts[own]


TALLY = "size int, total long, hashes binary, counts binary"


def _tallies(size: int, total: int, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([total]), pa.array([values.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], ["size", "total", "hashes", "counts"])


def frequent(docs: DataFrame, sizes: tuple[int, ...], keep: int) -> tuple[list[np.ndarray], int]:
    """For each window size the sorted hashes of at most ``keep`` frequent windows; and the number of all windows of the first.

    Each task sends one tally, less what occurs in it but once or in less than
    one in ``keep`` of its windows; tallies are merged in two steps. A window
    that is not returned has less than three in ``keep`` of all occurrences and
    one for each task.
    """

    def run(batches):
        tallies = [Tally(keep) for _ in sizes]
        for b in batches:
            for w in vec.words(b.column(1)):
                for t, size in zip(tallies, sizes):
                    t.add(vec.windows(w, size)[1])
        for size, t in zip(sizes, tallies):
            t.fold()
            yield _tallies(size, t.total, *t.shares(2))

    def merge(batches):
        tallies: dict[int, Tally] = {}
        for b in batches:
            for size, total, h, n in zip(*(c.to_pylist() for c in b.columns[:4])):
                tallies.setdefault(size, Tally(keep)).merge(np.frombuffer(h, np.uint64), np.frombuffer(n, np.int64), total)
        for size, t in tallies.items():
            yield _tallies(size, t.total, t.values, t.counts)

    parts = docs.select("doc_id", "text").mapInArrow(vec.tidy(run), TALLY).withColumn("part", F.spark_partition_id())
    some = parts.repartition(width(docs.sparkSession), "part").mapInArrow(vec.tidy(merge), TALLY)
    got = {size: Tally(keep) for size in sizes}
    for r in some.repartition(1).mapInArrow(vec.tidy(merge), TALLY).collect():
        got[r["size"]].merge(np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["counts"], np.int64), r["total"])
    return [np.sort(got[size].shares()[0]) for size in sizes], got[sizes[0]].total


def _among(sorted_values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each of ``h`` is one of the sorted values."""
    if not len(sorted_values):
        return np.zeros(len(h), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, h), len(sorted_values) - 1)] == h


def _lowest(h: np.ndarray, proof: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, proof), sorted, and the least document of each."""
    if not len(h):
        return h, proof, doc
    by = np.lexsort((proof, h))
    h, proof, doc = h[by], proof[by], doc[by]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (proof[1:] != proof[:-1]))))
    return h[first], proof[first], np.minimum.reduceat(doc, first)


def _owners(docs: DataFrame, size: int, hot) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The frequent windows of ``size`` words as sorted hashes and proofs, with the least document that holds each."""

    def run(batches):
        state = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for w in vec.words(b.column(1)):
                i, h = vec.windows(w, size)
                own = _among(hot.value, h)
                if own.any():
                    proof = vec.windows(w, size, vec.OTHER)[1][own] >> np.uint64(32)
                    doc = ids[w.lo + np.searchsorted(w.first, i[own], "right") - 1]
                    state = _lowest(*(np.concatenate(x) for x in zip(state, (h[own], proof, doc))))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in state], ["value", "proof", "doc"])

    least = docs.select("doc_id", "text").mapInArrow(vec.tidy(run), "value long, proof long, doc long").groupBy("value", "proof").agg(F.min("doc").alias("doc")).toArrow()
    value, proof, doc = (c.to_numpy().astype(np.int64) for c in least.columns)
    return _lowest(value.view(np.uint64), proof.view(np.uint64), doc)


SHARDED = "shard int, docs binary, counts binary, at binary"


def _to_shards(doc: np.ndarray, at: np.ndarray, shards: int):
    """Paired arrays as one row for each shard of documents, packed."""
    if not len(doc):
        return
    shard = (vec.mix(doc.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
    by = np.lexsort((at, doc, shard))
    doc, at, shard = doc[by], at[by], shard[by]
    edges = np.searchsorted(shard, np.arange(shards + 1))
    out = []
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own, counts = np.unique(doc[edges[k] : edges[k + 1]], return_counts=True)
        out.append((k, own.tobytes(), counts.astype("<u4").tobytes(), at[edges[k] : edges[k + 1]].astype("<u4").tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] + [pa.binary()] * 3)], ["shard", "docs", "counts", "at"])


def _by_document(sharded: DataFrame, shards: int) -> DataFrame:
    """One (doc_id, at) row for each document, its positions packed in order."""

    def run(batches, rows: int = 20_000):
        docs, ats = [], []
        for b in batches:
            for d, c, a in zip(*(x.to_pylist() for x in b.columns[1:])):
                docs.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, "<u4")))
                ats.append(np.frombuffer(a, "<u4"))
        if not docs:
            return
        doc, at = np.concatenate(docs), np.concatenate(ats)
        by = np.lexsort((at, doc))
        doc, at = doc[by], at[by]
        edges = np.append(np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), len(doc))
        for lo in range(0, len(edges) - 1, rows):
            some = edges[lo : lo + rows + 1]
            yield pa.RecordBatch.from_arrays([pa.array(doc[some[:-1]]), pa.array([at[x:z].tobytes() for x, z in zip(some, some[1:])], pa.binary())], ["doc_id", "at"])

    return sharded.repartitionById(shards, "shard").mapInArrow(vec.tidy(run), "doc_id long, at binary")


def _positions(packed: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(packed, "<u4").astype(np.int64))


def _probe(docs: DataFrame, block: int, buckets: int, hot) -> DataFrame:
    def run(batches):
        packs = Packer(buckets, wide=False), Packer(buckets, wide=False, settled=True)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for w in vec.words(b.column(1)):
                i, h = vec.windows(w, block)
                row = np.searchsorted(w.first, i, "right") - 1
                sure = _among(hot.value, h)
                for pack, own in zip(packs, (~sure, sure)):
                    pack.add(ids[w.lo : w.hi], row[own], (i - w.first[row])[own], h[own])
                    if pack.full():
                        yield from pack.emit()
        for pack in packs:
            yield from pack.emit()

    return docs.select("doc_id", "text").mapInArrow(vec.tidy(run), PACKED)


def _hits(packed: DataFrame, block: int, buckets: int) -> DataFrame:
    """(doc_id, at): windows of ``block`` words that an indexed block of another document equals, and those blocks; settled ones all."""

    def run(batches):
        doc, at, h, _, *settled = unpack(batches, wide=False)
        yield from _to_shards(*settled, buckets)
        if not len(h):
            return
        by = np.argsort(h, kind="stable")
        doc, at, h = doc[by], at[by], h[by]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
        indexed = at % (block + 1) == 0
        low = np.minimum.reduceat(np.where(indexed, doc, np.iinfo(np.int64).max), first)
        high = np.maximum.reduceat(doc, first)
        take = (doc > low[group]) | (indexed & (doc < high[group]))
        yield from _to_shards(doc[take], at[take], buckets)

    return _by_document(packed.repartitionById(buckets, "bucket").mapInArrow(vec.tidy(run), SHARDED), buckets)


def _extend(texts: DataFrame, size: int, block: int, buckets: int, owners) -> DataFrame:
    """Packed windows of ``size`` words around the hits of each (doc_id, text, hits); of frequent ones those that repeat."""

    def run(batches):
        packs = Packer(buckets, wide=True), Packer(buckets, wide=True, settled=True)
        known, proven, least = owners.value
        for b in batches:
            ids, hits = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_pylist()
            for w in vec.words(b.column(1)):
                i, h = vec.windows(w, size)
                _, proof = vec.windows(w, size, vec.OTHER)
                edges = np.searchsorted(i, w.first)
                rows, ats, hs, proofs = [], [], [], []
                for r in range(w.hi - w.lo):
                    n = int(edges[r + 1] - edges[r])
                    if not n:
                        continue
                    at = _positions(hits[w.lo + r])
                    near = np.zeros(n + size + 1, np.int32)  # starts from `block` before a hit to the hit
                    at = at[at < n + block]
                    np.add.at(near, np.maximum(at - (size - block), 0), 1)
                    np.add.at(near, np.minimum(at + 1, n), -1)
                    own = np.flatnonzero(np.cumsum(near[:n]) > 0)
                    rows.append(np.full(len(own), r))
                    ats.append(own)
                    hs.append(h[edges[r] + own])
                    proofs.append(proof[edges[r] + own])
                if not rows:
                    continue
                row, at, own, check = (np.concatenate(x) for x in (rows, ats, hs, proofs))
                hot = np.flatnonzero(_among(known, own))
                place = np.searchsorted(known, own[hot])
                while len(some := np.flatnonzero((known[place] == own[hot]) & (proven[place] != check[hot] >> np.uint64(32)))):  # windows that share a hash
                    place[some] += 1
                again = np.zeros(len(own), bool)
                again[hot] = ids[w.lo + row[hot]] > least[place]
                rest = np.ones(len(own), bool)
                rest[hot] = False
                for pack, take in zip(packs, (rest, again)):
                    pack.add(ids[w.lo : w.hi], row[take], at[take], own[take], check[take])
                    if pack.full():
                        yield from pack.emit()
        for pack in packs:
            yield from pack.emit()

    return texts.mapInArrow(vec.tidy(run), PACKED)


def _repeats(packed: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, at): windows that a document with a smaller doc_id has too."""

    def run(batches):
        doc, at, h, proof, *settled = unpack(batches, wide=True)
        yield from _to_shards(*settled, buckets)
        if not len(h):
            return
        by = np.lexsort((proof, h))
        doc, at, h, proof = doc[by], at[by], h[by], proof[by]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (proof[1:] != proof[:-1]))))
        low = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(h))))
        yield from _to_shards(doc[doc > low], at[doc > low], buckets)

    return _by_document(packed.repartitionById(buckets, "bucket").mapInArrow(vec.tidy(run), SHARDED), buckets)


def repeated_windows(docs: DataFrame, size: int = 50, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, parts): packed starts of the windows of ``size`` words that a document with a smaller doc_id has too.

    There are as many buckets as it takes to hold BUCKET windows each, with at
    least the session's shuffle partitions and at most BUCKETS.
    """
    block = size // 2
    sc = docs.sparkSession.sparkContext
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    (hot, wide), total = frequent(named, (block, size), counters)
    owners = sc.broadcast(_owners(named, size, sc.broadcast(wide)))
    buckets = min(max(width(docs.sparkSession), -(-total // BUCKET)), BUCKETS)
    hits = cut(_hits(_probe(named, block, buckets, sc.broadcast(hot)), block, buckets).withColumnRenamed("at", "hits"))
    near = named.join(small_side(hits.select("doc_id")), "doc_id", "left_semi").join(hits, "doc_id").select("doc_id", "text", "hits")
    return cut(_repeats(_extend(near, size, block, buckets, owners), buckets).withColumnRenamed("at", "parts"))


def remove_repeats(docs: DataFrame, size: int = 50, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): words of repeated windows removed, the rest joined by one space.

    Words are what bytes 9 to 13 and 32 part. Null and empty texts have none.
    Documents shorter than ``size`` words keep all. doc_id is to be unique;
    rows that repeat one with the same text are treated alike. A null doc_id
    is smaller than none and keeps all. Only doc_id and text are read.
    """
    found = repeated_windows(docs, size, counters)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = small_side(found.select(F.col("doc_id").alias("__id")))
    hit = read.join(ids, F.col("doc_id") == F.col("__id"), "left_semi").join(found, "doc_id").select("doc_id", "text", "parts")
    clean = read.join(ids, F.col("doc_id") == F.col("__id"), "left_anti").select("doc_id", "text", F.lit(None).cast("binary").alias("parts"))

    def run(batches):
        for b in batches:
            parts = b.column(2).to_pylist()
            n_words, n_removed, kept = [], [], []
            for w in vec.words(b.column(1)):
                for r in range(w.hi - w.lo):
                    lo, hi = int(w.first[r]), int(w.first[r + 1])
                    gone = np.zeros(hi - lo + 1, np.int32)
                    if parts[w.lo + r]:
                        at = _positions(parts[w.lo + r])
                        at = at[at + size <= hi - lo]
                        gone[at] += 1
                        np.add.at(gone, at + size, -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    n_words.append(hi - lo)
                    n_removed.append(int((~stay).sum()))
                    if hi == lo:
                        kept.append(b"")
                        continue
                    body = w.data[w.start[lo] : w.end[hi - 1]].tobytes().split()
                    kept.append(b" ".join(body if stay.all() else [x for x, s in zip(body, stay.tolist()) if s]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    out = hit.union(clean).mapInArrow(vec.tidy(run), "doc_id long, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


def repeat_digest(docs: DataFrame, size: int = 50, counters: int = COUNTERS) -> DataFrame:
    """``remove_repeats`` with the kept text as its digest."""
    return remove_repeats(docs, size, counters).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
