"""Secret scans: base patterns, and a character convolutional network over every other candidate.

The network sees one-hot classes of a candidate's characters and, apart from
these, of its surroundings: one convolution, ReLU, the maximum over all positions
of the whole candidate, one linear unit; plain numpy. It is trained on all base
findings and all other candidates of all documents, each whole: tasks learn from
shards of them side by side, and their networks are averaged after every round.
Of the other candidates, what stands in several different surroundings is no
secret; the rest count as unlabelled. Logits are calibrated on the quarter that
was not trained on, and the threshold is the highest that keeps the wanted recall
there on base findings of every kind; both are counted over all of that quarter.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import cut, lookup, shared_folder

# The base patterns.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "cnn")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{11,}[A-Za-z0-9+/_=-]")
BEFORE, AFTER = 24, 8
WINDOW = BEFORE + 40 + AFTER  # of a candidate of 40 characters
PIECE, BLOCK = 8192, 32768  # positions of the convolution that are held at once
INSIDE = 12  # classes of a candidate's characters; as many more are for its surroundings
CLASSES = 2 * INSIDE
COMMON = 4  # different surroundings that make a candidate a common word
UNSURE = 0.1
# Training: a table's examples are dealt by hash to PARTS, each part to shards of about SHARD examples.
PARTS, SHARD = 8, 8192
EPOCHS, EFFORT = 12, 72_000  # a small table is learnt from again, up to EPOCHS times, until EFFORT examples were seen
BATCH, BATCH_CHARACTERS = 64, 1 << 20
ONE = 1_000_000  # a target of 1; targets are whole numbers, so that their sums do not depend on an order
SEEN = 4  # the kind of a candidate that touches a base finding: it counts for what is common and is not learnt from
EXAMPLE = "key long, kind int, name long, before long, x binary, part int"


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of 12 or more key characters, of any mixture; a closing dot is left out."""
    return [m.span() for m in CANDIDATE.finditer(text)]


def apart(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Those of the ``spans`` that touch no base finding; both are sorted by start."""
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    out = []
    for s, e in spans:
        k = bisect_left(starts, e)  # findings that begin before the span ends
        if not k or reach[k - 1] <= s:
            out.append((s, e))
    return out


def _class_table() -> np.ndarray:
    t = np.full(128, 11, np.uint8)
    for k, chars in enumerate(("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "01234567", "89", "+/", "=", "-_.", " \t\r\n", "\"':;,")):
        for c in chars:
            t[ord(c)] = k
    return t


_TABLE = _class_table()


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Character classes of the whole span and its surroundings; CLASSES stands for nothing there."""
    part = text[max(0, start - BEFORE) : end + AFTER]
    codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    lead = max(0, BEFORE - start)
    out = np.full(BEFORE + end - start + AFTER, CLASSES, np.uint8)
    out[lead : lead + len(codes)] = _TABLE[np.minimum(codes, 127)] + INSIDE
    out[lead + len(codes) :] = CLASSES
    out[BEFORE : BEFORE + end - start] -= INSIDE
    return out


class CharNet:
    """Convolution of ``filters`` by ``reach`` characters, maximum over positions, a linear unit."""

    def __init__(self, filters: int = 24, reach: int = 5, seed: int = 7):
        r = np.random.default_rng(seed)
        self.reach = reach
        self.kernel = r.normal(0, 0.25, (reach, CLASSES + 1, filters))
        self.shift = np.zeros(filters)
        self.out, self.bias = r.normal(0, 0.25, filters), np.zeros(1)
        self.first, self.second, self.steps = [np.zeros_like(v) for v in self._values()], [np.zeros_like(v) for v in self._values()], np.zeros(1)

    def _values(self) -> list[np.ndarray]:
        return [self.kernel, self.shift, self.out, self.bias]

    def state(self) -> np.ndarray:
        """All that training changes, as one vector."""
        return np.concatenate([v.ravel() for v in (*self._values(), *self.first, *self.second, self.steps)])

    def resume(self, state: np.ndarray) -> CharNet:
        at = 0
        for v in (*self._values(), *self.first, *self.second, self.steps):
            v[...] = state[at : at + v.size].reshape(v.shape)
            at += v.size
        return self

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        n = len(x) - self.reach + 1
        return sum(self.kernel[j][x[j : j + n]] for j in range(self.reach)) + self.shift

    def _blocks(self, xs):
        """(owners, starts, characters, values) of blocks of pieces that together hold every position of every sequence once."""
        own, parts, size = [], [], 0
        for i, x in enumerate(xs):
            for lo in range(0, len(x) - self.reach + 1, PIECE):
                own.append(i)
                parts.append(x[lo : lo + PIECE + self.reach - 1])
                size += len(parts[-1])
                if size >= BLOCK:
                    yield self._block(own, parts)
                    own, parts, size = [], [], 0
        if own:
            yield self._block(own, parts)

    def _block(self, own, parts):
        flat = np.concatenate(parts)
        starts = np.cumsum([0] + [len(p) for p in parts])
        h = self._hidden(flat)
        for j in range(1, self.reach):  # positions across two pieces
            h[starts[1:-1] - j] = -np.inf
        return np.array(own), starts[:-1], flat, h

    def logits(self, xs) -> np.ndarray:
        """Of each sequence of classes, which may differ in length, over all its positions."""
        most = np.zeros((len(xs), len(self.out)))
        for own, starts, _, h in self._blocks(xs):
            np.maximum.at(most, own, np.maximum.reduceat(h, starts))
        return most @ self.out + self.bias

    def _best(self, xs) -> tuple[np.ndarray, np.ndarray]:
        """Of each sequence and filter the largest value, and the characters it was found at."""
        top = np.full((len(xs), len(self.out)), -np.inf)
        at = np.zeros((len(xs), len(self.out), self.reach), np.uint8)
        for own, starts, flat, h in self._blocks(xs):
            for i, lo, hi in zip(own, starts, [*starts[1:], len(h)]):
                best = lo + h[lo:hi].argmax(0)
                value = h[best, np.arange(len(best))]
                more = value > top[i]
                top[i][more] = value[more]
                at[i][more] = flat[best[more][:, None] + np.arange(self.reach)]
        return top, at

    def train(self, x, y: np.ndarray, epochs: int = 12, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the class-balanced logistic loss; targets from 0 to 1."""
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            for some in np.array_split(r.permutation(len(x)), max(1, len(x) // BATCH)):
                self.step([x[i] for i in some], y[some], *balance(len(y), y.sum()), rate)

    def step(self, xs, y: np.ndarray, yes: float, no: float, rate: float = 0.01) -> None:
        """One step of Adam; ``yes`` and ``no`` weigh the loss of the targets 1 and 0."""
        top, at = self._best(xs)
        on = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(on @ self.out + self.bias, -30, 30)))
        d = (no * p * (1 - y) - yes * (1 - p) * y) / max(1, len(y))
        back = d[:, None] * self.out * (top > 0)
        kernel, f = np.zeros_like(self.kernel), np.arange(len(self.out))
        for j in range(self.reach):
            np.add.at(kernel[j], (at[:, :, j], f[None, :]), back)
        self.steps += 1
        for v, g, m, s in zip(self._values(), (kernel, back.sum(0), on.T @ d, np.array([d.sum()])), self.first, self.second):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-8)


def balance(n: int, positive: float) -> tuple[float, float]:
    """Weights of the targets 1 and 0 by which both classes count alike."""
    return n / max(1, 2 * positive), n / max(1, 2 * (n - positive))


def platt(score: np.ndarray, y: np.ndarray, times: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-a * score - b)), by Newton's method on Platt's smoothed targets; ``times`` tells how often each row occurs."""
    n, positive = times.sum(), times[y > 0].sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (n - positive + 2))
    x, v = np.stack([score, np.ones(len(score))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (times * (p - target)) + 1e-3 * v)
        v = v - step * min(1.0, 2 / max(1e-12, np.abs(step).max()))
    return float(v[0]), float(v[1])


def half(v: np.ndarray) -> np.ndarray:
    """The largest number of half precision that is not above each value."""
    with np.errstate(over="ignore"):
        h = v.astype(np.float16)
    return np.where(h > v, np.nextafter(h, np.float16(-np.inf)), h).astype(float)


def fit(docs: DataFrame, recall: float = 0.95) -> tuple[CharNet, float]:
    """Network and threshold, from all findings and all other candidates of all documents.

    Base findings are positive, an assigned value without its key name, which
    no other candidate has. Candidates that touch none are unlabelled; those
    that all documents show after COMMON different surroundings or more are
    negative; copies of a document add none. A quarter, by a hash of document,
    place and characters, is left out of training. Two first networks, each on
    half of the others, tell positive from unlabelled; their probabilities,
    calibrated on the quarter, give the unlabelled candidates of the other half
    their chance to be positive (Elkan and Noto). It is their target for the
    network that is returned, which does not learn from those with a chance of
    ``UNSURE`` or more. Its logits are calibrated on the quarter (Platt); the
    threshold is the highest number of half precision that keeps ``recall`` of
    the positive ones of every kind there. The driver gets averaged networks
    and counts by half-precision logit, sizes that no input changes.
    """
    spark = docs.sparkSession
    base = f"{shared_folder(spark)}/secrets-{uuid.uuid4().hex}"
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(vec.tidy(_examples), EXAMPLE).write.partitionBy("part").parquet(f"{base}/examples")
    rows = spark.read.schema(EXAMPLE).parquet(f"{base}/examples")
    held, side = F.col("key") % 4 == 0, (F.shiftright("key", 2) % 2).cast("int")
    sides = {r.held for r in rows.where("kind < 3").select(held.alias("held")).distinct().collect()}
    if not sides:
        return CharNet(), float("inf")  # no labelled finding in any document, so there is nothing to learn from
    if len(sides) < 2:
        held, test = F.lit(False), F.lit(True)
    else:
        test = held
    learnt, tested = rows.where(~held & (F.col("kind") < SEEN)), rows.where(test & (F.col("kind") < SEEN))
    first = _learn(learnt.select(side.alias("net"), "part", "key", "x", F.when(F.col("kind") < 3, ONE).otherwise(0).alias("target")), 2)
    odds = []
    for score, kind, times in _tally(tested, first):
        a, b = platt(score, kind < 3, times)
        p = _chance(a * score + b)
        # The share of the positive ones that the base patterns find: hex runs all, so the least of the kinds.
        labelled = min(np.average(p[kind == n], weights=times[kind == n]) for n in range(3) if (kind == n).any())
        odds.append((a, b, (1 - labelled) / labelled))
    # Names in many surroundings are common; frequent ones stand beside them, so that the join can deal these.
    names = rows.where("kind >= 3").groupBy("name", "before").agg(F.count("*").alias("n")).groupBy("name").agg(F.sum("n").alias("n"), (F.count("*") >= COMMON).alias("common"))
    others = lookup(learnt.where("kind = 3"), cut(names.where("common OR n >= 1000")), ["name"], "n", "left")
    columns = ("key", "kind", "x", "part", side.alias("side"))
    judged = learnt.where("kind < 3").select(*columns, F.lit(False).alias("common")).union(others.select(*columns, F.coalesce("common", F.lit(False))))
    judged.mapInArrow(vec.tidy(_targets(spark.sparkContext.broadcast((first, odds)))), "net int, part int, key long, x binary, target int").write.partitionBy("part").parquet(f"{base}/targets")
    net = _learn(spark.read.schema("net int, key long, x binary, target int, part int").parquet(f"{base}/targets"), 1)[0]
    ((score, kind, times),) = _tally(tested, [net])
    a, b = platt(score, kind < 3, times)
    if a > 0:
        net.out, net.bias = a * net.out, a * net.bias + b
    ((score, kind, times),) = _tally(tested.where("kind < 3"), [net])
    least = float("inf")
    for n in range(3):
        if (kind == n).any():
            order = np.argsort(score[kind == n])
            upto = np.cumsum(times[kind == n][order])
            least = min(least, score[kind == n][order][np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")])
    return net, float(least)


def _examples(batches):
    """Every base finding and every other candidate, with classes of all its characters; of candidates that touch a finding the names alone."""
    kept, size = [], 0
    for doc, text in vec.rows(batches):
        text = text or ""
        base, spans = base_findings(text), candidates(text)
        free = set(apart(spans, base))
        for s, e, kind in [(s, e, k) for s, k, e in base] + [(s, e, 3 if (s, e) in free else SEEN) for s, e in spans]:
            key = int.from_bytes(hashlib.blake2b(f"{doc}:{s}:{text[s:e]}".encode(), digest_size=7).digest(), "big")
            before, x = text[max(0, s - BEFORE) : s], b""
            if kind < SEEN:
                value = ASSIGN.match(text, s).start(2) if kind == 0 else s
                x = encode(before + text[value : e + AFTER], len(before), len(before) + e - value).tobytes()
            kept.append((key, kind, _short(text[s:e]), _short(before), x, key // 8 % PARTS))
            size += 100 + len(x)
            if size >= BATCH_CHARACTERS:
                yield _packed(kept)
                kept, size = [], 0
    if kept:
        yield _packed(kept)


def _packed(kept: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), types)], ["key", "kind", "name", "before", "x", "part"])


def _short(part: str) -> int:
    return int.from_bytes(hashlib.blake2b(part.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def _classes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint8) for x in column.to_pylist()]


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _learn(rows: DataFrame, nets: int) -> list[CharNet]:
    """Networks from all ``rows`` (net, part, key, x, target), network ``net`` from those with its number.

    A round deals a part of the rows to shards of about SHARD of them. Each shard
    takes the networks as they are, trains its own in an order by hash, and the
    means of all shards, Adam's moments with them, go into the next round. Means
    are of decimals, so they do not depend on the order of tasks. The number of
    rounds is bounded; shards grow in number with the rows.
    """
    sums = {r.net: (r.n, r.target / ONE) for r in rows.groupBy("net").agg(F.count("*").alias("n"), F.sum("target").alias("target")).collect()}
    made, most = [CharNet() for _ in range(nets)], max(n for n, _ in sums.values())
    parts = next(p for p in (8, 4, 2, 1) if p == 1 or most >= p * SHARD)
    shards = -(-most // (parts * SHARD))
    weights = {net: balance(n, positive) for net, (n, positive) in sums.items()}
    epochs = min(EPOCHS, -(-EFFORT // most))
    alone = parts * shards == 1  # one shard has nothing to wait for and takes its epochs at once
    for r in range(1 if alone else parts * epochs):
        sent = rows.sparkSession.sparkContext.broadcast([net.state() for net in made])
        shard = (F.col("net") * shards + F.shiftright("key", 6) % shards).cast("int")
        epoch = F.explode(F.sequence(F.lit(1), F.lit(epochs))) if alone else F.lit(r)
        dealt = rows.where(F.col("part") % parts == r % parts).withColumn("shard", shard).withColumn("epoch", epoch).repartitionById(nets * shards, F.col("shard"))
        trained = dealt.sortWithinPartitions("shard", "epoch", F.xxhash64("key", "epoch"), "key", "target", "x").select("net", "shard", "target", "x").mapInArrow(vec.tidy(_rounds(sent, weights)), "net int, state array<double>")
        means = trained.select("net", F.posexplode("state").alias("at", "v")).groupBy("net", "at").agg(F.sum(F.col("v").cast("decimal(28,18)")).alias("v"), F.count("*").alias("n"))
        states = [net.state() for net in made]
        for m in means.collect():
            states[m.net][m.at] = float(m.v) / m.n
        for net, state in zip(made, states):
            net.resume(state)
        sent.unpersist()
    return made


def _rounds(sent, weights: dict[int, tuple[float, float]]):
    """Trains a network a shard; rows come by shard."""

    def run(batches):
        now, xs, ys, size = None, [], [], 0

        def learn():
            nonlocal xs, ys, size
            if xs:
                own.step(xs, np.array(ys) / ONE, *weights[now[0]])
            xs, ys, size = [], [], 0

        def result():
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([own.state()], pa.list_(pa.float64()))], ["net", "state"])

        for net, shard, target, x in vec.rows(batches):
            if (net, shard) != now:
                if now:
                    learn()
                    yield result()
                now, own = (net, shard), CharNet().resume(sent.value[net])
            xs.append(np.frombuffer(x, np.uint8))
            ys.append(target)
            size += len(x)
            if len(xs) == BATCH or size >= BATCH_CHARACTERS:
                learn()
        if now:
            learn()
            yield result()

    return run


def _tally(rows: DataFrame, nets: list[CharNet]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each network the half-precision logits of all rows, kinds, and how often each pair occurs."""
    sent = rows.sparkSession.sparkContext.broadcast(nets)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                xs = _classes(part.column(1))
                for i, net in enumerate(sent.value):
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(xs), pa.int32()), part.column(0), pa.array(half(net.logits(xs)), pa.float64())], ["net", "kind", "score"])

    got = rows.select("kind", "x").mapInArrow(vec.tidy(run), "net int, kind int, score double").groupBy("net", "kind", "score").count().orderBy("net", "kind", "score").collect()
    out = []
    for i in range(len(nets)):
        score, kind, times = (np.array([r[c] for r in got if r.net == i]) for c in ("score", "kind", "count"))
        out.append((np.maximum(score, -65504.0), kind, times))
    return out


def _targets(sent):
    """Targets of all examples by the network that has not seen them; those with an unsure one are left out."""

    def run(batches):
        first, odds = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                key, kind, x, at, side, common = part.columns
                xs, kind, side, common = _classes(x), kind.to_numpy(), side.to_numpy(), common.to_numpy(zero_copy_only=False)
                target = np.where(kind < 3, 1.0, 0.0)
                for k, (a, b_, odd) in enumerate(odds):
                    some = np.flatnonzero((kind == 3) & ~common & (side != k))
                    p = _chance(a * first[k].logits([xs[i] for i in some]) + b_)
                    target[some] = np.clip(odd * p / (1 - p), 0, 1)
                keep = pa.array((kind < 3) | (target < UNSURE))
                made = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(xs)), pa.int32()), at, key, x, pa.array(np.round(target * ONE).astype(np.int32))], ["net", "part", "key", "x", "target"])
                yield made.filter(keep)

    return run


def scan_secrets(docs: DataFrame, fitted: tuple[CharNet, float] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_added, base_sha256, spans) of every document.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and
    then kind. The network only adds spans, of candidates that touch no base
    finding. Null counts as empty and has no spans. Repeated rows are each
    scanned; a null doc_id is kept. No documents give no rows. Only doc_id and
    text are read.
    """
    own = docs.sparkSession.sparkContext.broadcast(fitted or fit(docs))

    def run(batches):
        net, least = own.value
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, 1024):
                found, extra, xs = [], [], []
                for i, text in enumerate(texts.slice(lo, 1024).to_pylist()):
                    text = text or ""
                    base = base_findings(text)
                    found.append(base)
                    for s, e in apart(candidates(text), base):
                        extra.append((i, s, e))
                        xs.append(encode(text, s, e))
                added: list[list] = [[] for _ in found]
                if xs and np.isfinite(least):
                    for (i, s, e), hit in zip(extra, net.logits(xs) >= least):
                        if hit:
                            added[i].append((s, 3, e))
                write = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                count = [[sum(k == kind for _, k, _ in f) for f in found] for kind in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, 1024), *(pa.array(c, pa.int64()) for c in count), pa.array([len(a) for a in added], pa.int64()), pa.array([hashlib.sha256(write(f).encode()).hexdigest() for f in found]), pa.array([write(sorted(f + a)) for f, a in zip(found, added)])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "n_added", "base_sha256", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(vec.tidy(run), "doc_id long, n_assign long, n_access long, n_hex long, n_added long, base_sha256 string, spans string")
