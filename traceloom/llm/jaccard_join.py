"""N-gram Jaccard join by a token-group matrix.

Similar documents are first drawn to star centres; verified star links make the
first components. Components, and the documents that are near one centre
without a link, are the groups, in shards of about ``shard`` documents, and each
is represented by the union of its tokens. The matrix of prefix tokens and
groups, sorted by a shared rarity order, yields (query, group) pairs; a group is
opened for a query only if the union holds enough of the query's tokens, and
then its members are verified. Prefix filtering and the group bound are exact:
no link between documents of different groups is lost, and links inside a group
cannot change its component.

Hot keys: the rows of a frequent text, band, centre or component are joined by
``lookup``; a centre asked by many is copied; a token of many documents is met
block against block in tasks of their own.

Tokens are 64-bit hashes of word shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.operators.graph import connected_components
from traceloom.session import cut, lookup, small_side, width

BANDS, ROWS = 6, 2
SEEDS = [vec.BASE * (2 * i + 3) % (1 << 64) | 1 for i in range(BANDS * ROWS)]
BYTES = 4 << 20  # of a batch that a task sends
FEATURES = "doc_id long, n long, set_a long, set_b long, bands array<long>, prefix binary"


def _sets(column, size: int):
    """(row, sorted distinct token hashes) of every row of a text column."""
    for w in vec.words(column, lower=True):
        at, h = vec.windows(w, size)
        edges = np.searchsorted(at, w.first)
        for r in range(w.hi - w.lo):
            own = h[edges[r] : edges[r + 1]]
            n = int(w.first[r + 1] - w.first[r])
            if 0 < n < size:
                lone = w.hashes[w.first[r] : w.first[r + 1]] * vec.powers(vec.BASE, n)
                own = vec.mix(lone.sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
            own = np.sort(own)
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            yield w.lo + r, own


def _frequencies(docs: DataFrame, size: int, bits: int, slices: int = 64) -> np.ndarray:
    """Counts of tokens by the low ``bits`` of their hash, on a log scale of 256 steps.

    Only an order: any values give right results. Every task sends at most
    2**bits 16-bit counters, in slices that are summed apart.
    """
    step = (1 << bits) // slices

    def add_to(seen, held):
        which, counts = np.unique(np.concatenate(held), return_counts=True)
        seen[which] += counts.astype(np.uint32)

    def count(batches):
        seen = np.zeros(1 << bits, np.uint32)
        mask, held = np.uint64((1 << bits) - 1), []
        total = 0
        for b in batches:
            for w in vec.words(b.column(0), lower=True):
                h = vec.windows(w, size)[1]
                held.append((h & mask).astype(np.uint32))
                total += len(h)
                if total > 1 << 20:
                    add_to(seen, held)
                    held, total = [], 0
        if total:
            add_to(seen, held)
        short = np.minimum(seen, 65535).astype("<u2").reshape(slices, step)
        some = [i for i in range(slices) if short[i].any()]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([short[i].tobytes() for i in some], pa.binary())], ["slice", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(raw, "<u2").astype(np.int64)
        if sums:
            level = [np.minimum(np.log2(v + 1.0) * 8, 255).astype(np.uint8).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())], ["slice", "counts"])

    parts = docs.select("text").mapInArrow(vec.tidy(count), "slice int, counts binary").repartition(min(slices, width(docs.sparkSession)), "slice")
    out = np.zeros((slices, step), np.uint8)
    for i, raw in parts.mapInArrow(vec.tidy(add), "slice int, counts binary").collect():  # 2**bits bytes in all
        out[i] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def _features(docs: DataFrame, size: int, percent: int, level) -> DataFrame:
    def run(batches):
        order = level.value
        mask = np.uint64(len(order) - 1)
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
        for b in batches:
            ids = b.column(0).to_pylist()
            rows, held = [], 0
            for r, t in _sets(b.column(1), size):
                n = len(t)
                if not n:
                    rows.append((ids[r], 0, 0, 0, [], b""))
                    continue
                mins = [int((t * np.uint64(s)).min()) for s in SEEDS]
                bands = [hash((i, *mins[i * ROWS : (i + 1) * ROWS])) for i in range(BANDS)]
                need = (percent * n + 99) // 100
                rare = np.lexsort((t, order[(t & mask).astype(np.int64)]))[: n - need + 1]
                both = vec.mix(t ^ np.uint64(SEEDS[0]))
                rows.append((ids[r], n, int(t.sum(dtype=np.uint64).astype(np.int64)), int(both.sum(dtype=np.uint64).astype(np.int64)), bands, t[rare].tobytes()))
                held += 8 * len(rare)
                if held > BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n", "set_a", "set_b", "bands", "prefix"])
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "n", "set_a", "set_b", "bands", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(vec.tidy(run), FEATURES)


def _token_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, tokens) of the documents named in ``ids``."""

    def run(batches):
        for b in batches:
            own, found, held = b.column(0).to_pylist(), [], 0
            for r, t in _sets(b.column(1), size):
                found.append((own[r], t.tobytes()))
                held += 8 * len(t)
                if held > BYTES or r + 1 == len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.binary())], ["doc_id", "tokens"])
                    found, held = [], 0

    few = small_side(ids.select(F.col("doc_id").alias("__id")))
    wanted = docs.select(F.col("doc_id").cast("long"), "text").join(few, F.col("doc_id") == F.col("__id"), "left_semi")
    return wanted.mapInArrow(vec.tidy(run), "doc_id long, tokens binary")


def _verify(asked: DataFrame, members: DataFrame, sets: DataFrame, percent: int, load: int = 256) -> DataFrame:
    """Links (src, dst): the members of a host are gathered, and its queries streamed past them.

    ``asked``, a written table, has (query, host), ``members`` (host, member,
    gid), where members of one gid are known to be connected. A host with many
    queries is copied, so that each copy is asked by about ``load`` of them.
    """
    spark = asked.sparkSession
    hot = cut(asked.groupBy("host").agg(F.count("*").alias("k")).where(F.col("k") > load).withColumn("copies", F.ceil(F.col("k") / load).cast("int")))
    copies = F.coalesce("copies", F.lit(1))
    who = lookup(asked, hot, ["host"], "k", "left").select("host", F.pmod(F.xxhash64("query"), copies).cast("int").alias("copy"), F.col("query").alias("doc_id"), F.lit(1).alias("role"), F.lit(0).cast("long").alias("gid"))
    inner = lookup(members, hot, ["host"], "k", "left").select("host", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"), F.col("member").alias("doc_id"), F.lit(0).alias("role"), "gid")
    rows = inner.union(who).join(sets, "doc_id").select(F.xxhash64("host", "copy").alias("host"), "role", "doc_id", "gid", "tokens")

    def run(batches):
        host, ids, inside, union, out = None, [], [], None, set()
        for h, role, doc, gid, raw in vec.rows(batches):
            if h != host:
                if out:
                    yield _pairs(np.array(sorted(out), np.int64))
                    out.clear()
                host, ids, inside, union = h, [], [], None
            t = np.frombuffer(raw, np.uint64)
            if role == 0:
                ids.append((doc, gid))
                inside.append(t)
                continue
            if not inside:
                continue
            if union is None:
                union = np.unique(np.concatenate(inside))
            if 100 * np.isin(t, union, assume_unique=True).sum() < percent * len(t):
                continue  # the group stays closed
            joined = set()
            for (other, of), own in zip(ids, inside):
                if other == doc or of in joined or 100 * min(len(own), len(t)) < percent * max(len(own), len(t)):
                    continue
                same = len(np.intersect1d(t, own, assume_unique=True))
                if 100 * same >= percent * (len(own) + len(t) - same):
                    out.add((doc, other))
                    joined.add(of)  # one link joins the query to all of that component
        if out:
            yield _pairs(np.array(sorted(out), np.int64))

    return rows.repartition(width(spark), "host").sortWithinPartitions("host", "role").mapInArrow(vec.tidy(run), "query long, host long").toDF("src", "dst")


def _cross(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Rows (query, host) of documents of ``a`` that ask hosts of ``b``.

    Columns are documents that hold one token; rows are doc, n, gid, gsize, host
    and early. A document asks the hosts of larger groups, so a large group is
    asked, not asking. Of a pair, the smaller document has its first shared
    token in its early prefix.
    """
    by = np.lexsort((b[4], b[2], b[3]))
    doc_n, (gid, size, host) = b[1][by], b[2:5, by]
    first = np.flatnonzero(np.concatenate(([True], (gid[1:] != gid[:-1]) | (host[1:] != host[:-1]))))
    low, high = np.minimum.reduceat(doc_n, first), np.maximum.reduceat(doc_n, first)
    early = np.maximum.reduceat(b[5][by], first)
    gid, size, host = gid[first], size[first], host[first]
    found = [np.zeros((0, 2), np.int64)]
    own = a[:, np.lexsort((a[2], a[3]))]
    for lo in range(0, own.shape[1], 512):
        doc, n, g, k, _, soon = (x[:, None] for x in own[:, lo : lo + 512])
        at = int(np.searchsorted(size, k[0, 0]))  # groups that are smaller than any of these are not asked
        if at == len(size):
            continue
        asks = (size[at:] > k) | (size[at:] == k) & (gid[at:] > g)
        asks &= (100 * high[at:] >= percent * n) & (percent * low[at:] <= 100 * n)
        asks &= (soon > 0) & (n <= high[at:]) | (early[at:] > 0) & (low[at:] <= n)
        x, y = np.nonzero(asks)
        found.append(np.stack([doc[x, 0], host[at + y]], 1))
    return np.concatenate(found)


MET = "query long, hosts binary, token long, block int, blocks int, docs binary"


def _packed(pairs: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """One (query, hosts) for each query of the pairs."""
    both = np.unique(np.concatenate(pairs), axis=0)
    pairs.clear()
    if not len(both):
        return []
    edges = np.flatnonzero(np.concatenate(([True], both[1:, 0] != both[:-1, 0], [True]))).tolist()
    hosts = np.ascontiguousarray(both[:, 1])
    return [(int(both[a, 0]), hosts[a:z].tobytes()) for a, z in zip(edges, edges[1:])]


def _met(pairs: list[np.ndarray], blocks: list[tuple] = ()) -> Iterator[pa.RecordBatch]:
    """Packed pairs, and blocks of documents whose pairs are still to be found."""
    rows = [(*x, None, None, None, None) for x in (_packed(pairs) if pairs else [])] + [(None, None, *x) for x in blocks]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["query", "hosts", "token", "block", "blocks", "docs"])


def _matrix(reps: DataFrame, percent: int, total: int, flush: int = 10_000, block: int = 4096) -> DataFrame:
    """(query, host) pairs of documents and groups of other components that share a prefix token.

    Tokens are dealt to buckets of a bounded size. A token of over ``block``
    documents is cut in blocks, and each pair of blocks is met in a task of its
    own choosing.
    """
    buckets = max(width(reps.sparkSession), total >> 28)  # a bucket holds the prefixes of about 256 MB of text

    def deal(batches):
        names = ["bucket", "docs", "counts", "tokens"]
        held: list[tuple] = []

        def emit():
            docs = np.array([x[:5] for x in held], np.int64)
            t = np.concatenate([np.frombuffer(x[5], np.uint64) for x in held])
            sizes = np.array([len(x[5]) // 8 for x in held])
            row = np.repeat(np.arange(len(held)), sizes)
            # Of a pair, the smaller document's first shared token lies in a shorter prefix: one bit says so.
            place = np.arange(len(t)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            n = docs[:, 1]
            early = place < (n + 1 - (2 * percent * n + 99 + percent) // (100 + percent))[row]
            value = t >> np.uint64(33) << np.uint64(1) | early.astype(np.uint64)
            to = ((t & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            edges = np.searchsorted(to[by], np.arange(buckets + 1))
            out = []
            for k in np.flatnonzero(np.diff(edges)).tolist():
                at = by[edges[k] : edges[k + 1]]
                some, counts = np.unique(row[at], return_counts=True)
                out.append((k, docs[some].T.tobytes(), counts.astype("<u4").tobytes(), value[at].astype("<u4").tobytes()))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] + [pa.binary()] * 3)], names)

        size = 0
        for x in vec.rows(batches):
            held.append(x)
            size += len(x[5])
            if len(held) >= flush or size > 4 * BYTES:
                yield emit()
                size = 0
        if held:
            yield emit()

    def meet(batches):
        """The rows of one bucket after the other; those of a bucket follow one another."""
        now, own = None, []
        for bucket, *packed in vec.rows(batches):
            if bucket != now:
                yield from meet_bucket(now, own)
                now, own = bucket, []
            own.append(packed)
        yield from meet_bucket(now, own)

    def meet_bucket(bucket, packed):
        if not packed:
            return
        docs, rows, toks, base = [], [], [], 0
        for d, c, t in packed:
            counts = np.frombuffer(c, "<u4").astype(np.int64)
            docs.append(np.frombuffer(d, np.int64).reshape(5, -1))
            rows.append(np.repeat(np.arange(base, base + len(counts), dtype=np.int32), counts))
            toks.append(np.frombuffer(t, "<u4"))
            base += len(counts)
        doc, row, tok = np.concatenate(docs, 1), np.concatenate(rows), np.concatenate(toks)
        by = np.argsort(tok, kind="stable")
        row, tok = row[by], tok[by]
        edge = np.flatnonzero(np.concatenate(([True], tok[1:] >> 1 != tok[:-1] >> 1, [True])))
        gid = doc[2][row]
        low, high = np.minimum.reduceat(gid, edge[:-1]), np.maximum.reduceat(gid, edge[:-1])
        mixed = low != high
        found, held = [], 0
        for a, z in zip(edge[:-1][mixed].tolist(), edge[1:][mixed].tolist()):
            some = np.concatenate([doc[:, row[a:z]], (tok[a:z] & 1).astype(np.int64)[None]])
            if z - a <= block:
                found.append(_cross(some, some, percent))
                held += len(found[-1])
            else:
                parts = np.array_split(some, -(-(z - a) // block), 1)
                name = int(tok[a] >> 1) * buckets + bucket  # of the token; a bucket's tokens are told apart by 31 bits
                for i, part in enumerate(parts):
                    yield from _met([], [(name, i, len(parts), np.ascontiguousarray(part).tobytes())])
            if held > 200_000:
                yield from _met(found)
                held = 0
        yield from _met(found)

    def meet_blocks(batches):
        cell, first = None, None
        for x, y, token, docs in vec.rows(batches):
            now = np.frombuffer(docs, np.int64).reshape(6, -1)
            if x == y:
                yield from _met([_cross(now, now, percent)])
            elif cell != (token, x, y):
                cell, first = (token, x, y), now
            else:
                yield from _met([_cross(first, now, percent), _cross(now, first, percent)])

    def merge(batches):
        """Each pair once; the rows of a query follow one another."""
        now, own, out, held = None, [], [], 0
        for query, hosts in vec.rows(batches):
            if query != now and own:
                out.append(np.stack(np.broadcast_arrays(np.int64(now), np.unique(np.concatenate(own))), 1))
                held, own = held + len(out[-1]), []
                if held > 50_000:
                    yield _pairs(np.concatenate(out))
                    out, held = [], 0
            now = query
            own.append(np.frombuffer(hosts, np.int64))
        if own:
            out.append(np.stack(np.broadcast_arrays(np.int64(now), np.unique(np.concatenate(own))), 1))
        if out:
            yield _pairs(np.concatenate(out))

    parts = width(reps.sparkSession)
    packed = reps.select("doc_id", "n", "gid", "gsize", "host", "prefix").mapInArrow(vec.tidy(deal), "bucket int, docs binary, counts binary, tokens binary")
    met = cut(packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(vec.tidy(meet), MET))
    pairs = met.where("docs IS NULL").select("query", "hosts")
    hot = met.where("docs IS NOT NULL")
    if not hot.isEmpty():
        cells = hot.select("token", "block", "docs", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        cells = cells.select(F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "token", "docs")
        cells = cells.repartition(parts, "token", "x", "y").sortWithinPartitions("token", "x", "y")
        pairs = pairs.union(cells.mapInArrow(vec.tidy(meet_blocks), MET).select("query", "hosts"))
    return pairs.repartition(parts, "query").sortWithinPartitions("query").mapInArrow(vec.tidy(merge), "query long, host long")


def _bits(spark, total: int, most: int) -> int:
    """Counters of a task take at most half the bytes of the file part it reads."""
    part = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(12, min(most, int(np.log2(part / 4)), int(np.ceil(np.log2(total / 64 + 1)))))


def _pairs(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["query", "host"])


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, shard: int = 64, max_bits: int = 25, orders: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    A-Z are lower-cased, words split at white space; a document of fewer words
    than ``size`` is one shingle; null and empty texts have none and link with
    nothing. Two documents link when 100 * intersection >= percent * union.
    Equal texts are one component. Rows that repeat a doc_id are one document
    in links, and each is returned; a null doc_id is returned as its own null
    component. No rows give no rows. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    level = spark.sparkContext.broadcast(_frequencies(docs, size, _bits(spark, total, max_bits)))
    feats = cut(_features(docs, size, percent, level))
    named = feats.where("n > 0 AND doc_id IS NOT NULL")
    key = ["n", "set_a", "set_b"]
    same = cut(named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("k"), F.min_by("bands", "doc_id").alias("bands")))

    # Stars: a band's centres are the documents that come first in a few fixed orders; each document
    # proposes, in every order, the centre that most of its bands have.
    bands = same.select(F.col("rep").alias("doc_id"), F.explode("bands").alias("band"))
    first = [F.min("doc_id"), *(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(r))) for r in range(1, orders))]
    centres = cut(bands.groupBy("band").agg(F.array(*first).alias("hosts"), F.count("*").alias("k")).where("k > 1"))
    star = lookup(bands, centres, ["band"], "k").select("doc_id", F.posexplode("hosts").alias("turn", "host")).where("doc_id <> host")
    star = star.repartition("doc_id").groupBy("doc_id", "turn", "host").agg(F.count("*").alias("k"))
    star = star.groupBy("doc_id", "turn").agg(F.max(F.struct("k", (-F.col("host")).alias("h"))).alias("best"))
    star = cut(star.select(F.col("doc_id").alias("query"), (-F.col("best.h")).alias("host")).distinct())
    sets = _token_sets(docs, star.select(F.explode(F.array("query", "host")).alias("doc_id")).distinct(), size)
    centre = star.select("host", F.col("host").alias("member"), F.col("host").alias("gid")).distinct()
    links = cut(_verify(star, centre, sets, percent))
    groups = cut(connected_components(links))

    # The matrix: shards of groups, asked by documents of other groups.
    near = star.groupBy(F.col("query").alias("q")).agg(F.min("host").alias("near"))
    reps = same.select(F.col("rep").alias("doc_id")).distinct()
    cells = reps.join(groups, reps["doc_id"] == groups["node"], "left").join(near, F.col("doc_id") == F.col("q"), "left")
    cells = cut(cells.select(F.col("doc_id").alias("member"), F.coalesce("component", "doc_id").alias("gid"), F.coalesce("component", "near", "doc_id").alias("cluster")))
    wide = cut(cells.groupBy("cluster").agg(F.count("*").alias("wide")).where("wide > 1"))
    sizes = cut(groups.groupBy(F.col("component").alias("gid")).agg(F.count("*").alias("k")))
    host = F.when(F.col("wide").isNull(), F.col("member")).otherwise(F.xxhash64("cluster", F.pmod(F.xxhash64("member"), F.ceil(F.col("wide") / shard))))
    cells = cut(lookup(cells, wide, ["cluster"], "wide", "left").select("member", "gid", host.alias("host")))
    cells = cut(lookup(cells, sizes, ["gid"], "k", "left").select("member", "gid", F.coalesce("k", F.lit(1)).alias("gsize"), "host"))
    asked = cut(_matrix(named.select("doc_id", "n", "prefix").join(small_side(cells), F.col("doc_id") == F.col("member")), percent, total))
    members = cut(cells.select("host", "member", "gid").join(small_side(cut(asked.select("host").distinct())), "host"))
    wanted = asked.select(F.col("query").alias("doc_id")).union(members.select("member")).distinct()
    more = cut(_verify(asked, members, _token_sets(docs, wanted, size), percent))

    # A document whose rows have several texts joins their classes.
    rows = cut(lookup(feats.select("doc_id", *key), same.select(*key, "rep", "k"), key, "k", "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")))
    torn = cut(rows.where("rep IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select(F.col("doc_id").alias("src")))
    torn = rows.join(small_side(torn), F.col("doc_id") == F.col("src")).select("src", F.col("rep").alias("dst")).distinct()
    joined = connected_components(groups.select(F.col("node").alias("src"), F.col("component").alias("dst")).union(more).union(torn))
    weights = same.groupBy("rep").agg(F.sum("k").alias("k"))
    found = cut(weights.join(joined, F.col("rep") == F.col("node")).select("rep", "k", "component"))
    return lookup(rows, found, ["rep"], "k", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the document of the smallest doc_id of each component; all columns stay.

    Documents without words, and rows with a null doc_id, link with nothing and
    stay. Rows that repeat a doc_id are one document and go or stay together. No
    rows give no rows. Columns may have any name: both sides are named by alias.
    """
    found = jaccard_components(docs, size, percent)
    gone = cut(found.where("doc_id <> component_id").select("doc_id").distinct())
    return docs.alias("docs").join(small_side(gone).alias("gone"), F.col("docs.doc_id") == F.col("gone.doc_id"), "left_anti")
