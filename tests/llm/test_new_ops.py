"""Hard negatives, line dedup and alignment against brute force, and on awkward inputs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from test_ops import AWKWARD, awkward, documents, empty
from traceloom.llm import alignment, line_dedup, negatives, secrets
from traceloom.llm.queries import tokenizer

# op11

VECTORS = "vec_id long, embedding array<float>, label int, part string, mark long, low long, id long, dim int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "p", 1, 2, 3, 4) for i, v, l in rows], VECTORS)


def mined(rows, is_anchor, positives=5, negatives_=10):
    """By definition, for rows with distinct ids."""
    known = [(i, tuple(int(np.floor(np.float64(np.float32(x)) * 256)) for x in v), (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows
             if i is not None and l is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for a, av, al in known:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(av, v)), i, l) for i, v, l in known if i != a and len(v) == len(av))
        for s, p, _ in [x for x in scored if x[2] == al][:positives]:
            fits = [(-t, i) for t, i, l in scored if l != al and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (t, i) in enumerate(fits[:negatives_])]
    return sorted(out)


def ran(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("part_bytes", [200, 32 << 20])
def test_mining_against_the_definition(spark, part_bytes):
    """Clusters, equal vectors, ties, negative scores, a hot label, lengths 0 to 40; parts of few rows and of all."""
    r = random.Random(part_bytes)
    centres = [[r.gauss(0, 0.4) for _ in range(40)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.35) for x in r.choice(centres)], r.choice([0, 0, 0, 1, 2, 9])) for i in range(-30, 400)]
    rows += [(i, [0.5, -0.25] * 20, r.choice([0, 1])) for i in range(400, 520)]
    rows += [(i, [r.choice([0.0, 0.1]), 0.2][: i % 3], 1) for i in range(600, 640)]
    rows += [(None, [0.1] * 40, 0), (700, None, 0), (800, [0.1] * 40, None), (900, [0.1] * 39 + [None], 0), (1000, [float("nan")] * 40, 0), (1100, [float("inf")] * 40, 1)]
    got = ran(negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 20 == 0, part_bytes=part_bytes))
    assert got == mined(rows, lambda i: i % 20 == 0) and len(got) > 500


def test_mining_discards_rows_early_and_loses_none():
    """In data with few strong directions most rows leave before the last components; the survivors hold all that fit."""
    r = np.random.default_rng(3)
    v = np.floor((r.normal(size=(4000, 8)) @ r.normal(size=(8, 64)) + 0.05 * r.normal(size=(4000, 64))) * 256)
    axes = {64: np.linalg.eigh(v.T @ v)[1][:, ::-1].copy()}
    part = negatives.turn(list(range(4000)), [0] * 4000, [x.tobytes() for x in v], 64, axes)
    asks = negatives.turn(list(range(50)), [1] * 50, [x.tobytes() for x in v[:50]], 64, axes)
    scores = v[:50] @ v.T
    low = np.sort(scores, axis=1)[:, -20:-19].astype(np.int64)
    a, rows = negatives.survivors(asks, part, negatives.Wanted(low, np.full_like(low, 1 << 62), 10), np.ones((50, 4000), bool))
    assert set(zip(*np.nonzero(scores >= low))) <= set(zip(a, rows)) and len(a) < 50 * 30


def test_mining_on_awkward_tables(spark):
    no = negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 100 == 0)
    assert no.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and no.count() == 0
    alone = [(0, [0.5], 3), (1, [0.5], 4), (2, [0.4], 3)]
    assert ran(negatives.hard_negatives(vectors(spark, alone[:1]), F.col("vec_id") == 0)) == []
    twice = [(0, [0.5], 3), (0, [0.5], 3), (1, [0.5], 3), (2, [0.4], 4), (2, [0.4], 4), (3, [0.3], 4)]  # id 0 gets label 4 and has partners 2 and 3
    got = ran(negatives.hard_negatives(vectors(spark, twice), F.col("vec_id") == 1))
    assert got == []
    twice = [(100, [0.5], 3), (100, [0.5], 3), (1, [0.5], 3), (2, [0.4], 4), (2, [0.4], 4), (3, [0.3], 4)]
    assert ran(negatives.hard_negatives(vectors(spark, twice), F.col("vec_id") == 100)) == [(100, 1, k, n, 128 * 128, 128 * s) for k, n, s in ((1, 2, 102), (2, 2, 102), (3, 3, 76))]
    with pytest.raises(Exception, match="too large"):
        negatives.hard_negatives(vectors(spark, [(0, [1e9], 3)]), F.col("vec_id") == 0).count()


# op12


def kept_lines(docs, min_docs, min_chars=1, keep_first=False):
    """Rows are documents: (n_lines, n_dropped, kept text) of each."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    lines = [(t or "").split("\n") for _, t in docs]
    found = Counter(k for own in lines for k in {key(x) for x in own} if len(k) >= min_chars)
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    first = {}
    for i in order:
        for at, x in enumerate(lines[i]):
            first.setdefault(key(x), (docs[i], at))
    gone = lambda i, at, k: found[k] >= min_docs and not (keep_first and first[k] == (docs[i], at))
    kept = [[x for at, x in enumerate(own) if not gone(i, at, key(x))] for i, own in enumerate(lines)]
    return [(len(own), len(own) - len(k), hashlib.sha256("\n".join(k).encode()).hexdigest()) for own, k in zip(lines, kept)]


@pytest.mark.parametrize("limit", [1, 1000])
@pytest.mark.parametrize("keep_first", [False, True])
def test_lines_against_the_definition(spark, limit, keep_first):
    """Random texts of few lines, one of them in most documents; with nearly all keys hot, and with one."""
    r = random.Random(limit)
    some = ["Buy now", " buy NOW\t", "", "  ", "É", "é", "a", "A\r", "\x0b#", "hot", "x y", "ﬀ"]
    docs = [(i, "\n".join(r.choice([*some, "hot", "hot", str(r.randrange(90))]) for _ in range(r.randrange(0, 9)))) for i in range(300)] + [(None, "hot\nx y\nhot")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_lines, x.n_dropped, x.kept_sha256) for x in line_dedup.line_digest(frame, keep_first=keep_first, limit=limit, ranges=7).collect()}
    assert got == dict(zip((i for i, _ in docs), kept_lines(docs, 10, keep_first=keep_first)))


def test_lines_of_awkward_rows(spark):
    got = sorted((r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_digest(awkward(spark), min_docs=3).collect())
    assert got == sorted(kept_lines(AWKWARD, 3)) and any(d for _, d, _ in got)
    assert line_dedup.line_digest(empty(spark)).count() == 0
    dropped = line_dedup.drop_lines(awkward(spark), min_docs=3)
    assert dropped.columns == awkward(spark).columns
    texts = {(r.doc_id, r.text) for r in dropped.collect()}
    assert (1, None) in texts and (4, "") in texts and (12, "a b c") in texts and dropped.count() == len(AWKWARD)


def test_a_long_text_of_equal_lines_and_its_bitmap(spark):
    docs = spark.createDataFrame([(1, "\n".join(["same", "own 1", "own 2"] * 20_000)), *((i, "same") for i in range(2, 12))], "doc_id long, text string")
    bits = {r.doc_id: r for r in line_dedup.keep_bitmaps(docs).collect()}
    assert bits[1].n_dropped == 20_000 and len(bits[1].keep_runs) == 20_000  # its own lines are in one document, however often
    assert [tuple(x) for x in bits[1].keep_runs][:2] == [(1, 2), (4, 2)] and [r.start for r in bits[2].keep_runs] == [1]  # from behind its only line on


# op13


def aligned(texts):
    """By definition: (n_a, n_b, n_groups, n_links, n_best, count_sum, sha256) of each text."""
    a, b = alignment.tokenizers(tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    docs = []
    for t in texts:
        whole = f" {t or ''}".encode()
        x, y = (a.model.encode(whole.decode(), add_special_tokens=False).ids, b.model.encode(t)) if t else ([], [])
        ends = [np.cumsum([len(c.token[i]) for i in ids]).tolist() for c, ids in ((a, x), (b, y))]
        if not t or b"".join(map(a.token.__getitem__, x)) != whole or b"".join(map(b.token.__getitem__, y)) != whole:
            docs.append(None)
            continue
        spans = [list(zip([0, *e], e)) for e in ends]
        links = [(x[i], y[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1][max(0, np.searchsorted(ends[1], s) - 1) :], max(0, np.searchsorted(ends[1], s) - 1)) if s < v and u < e] if len(t) < 3000 else None
        if links is None:  # long texts: walk both lists at once
            links, i, j = [], 0, 0
            while i < len(x) and j < len(y):
                links.append((x[i], y[j]))
                d, f = ends[0][i], ends[1][j]
                i, j = i + (d <= f), j + (f <= d)
        groups, lo = [], (0, 0)
        for e in sorted(set(ends[0]) & set(ends[1])):
            hi = ends[0].index(e, lo[0]) + 1, ends[1].index(e, lo[1]) + 1
            groups.append(f"{','.join(map(str, x[lo[0]:hi[0]]))}|{','.join(map(str, y[lo[1]:hi[1]]))}")
            lo = hi
        docs.append((len(x), len(y), links, groups))
    counts = Counter(p for d in docs if d for p in set(d[2]))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    digest = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest()
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (d[0], d[1], len(d[3]), len(d[2]), sum(counts[p] == top[p[0]] for p in d[2]), sum(map(counts.__getitem__, d[2])), digest(d[3])) for d in docs]


def numbers(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def test_alignment_of_whole_table(spark, small):
    docs = documents(spark, small)
    got = {r.doc_id: numbers(r) for r in entry.queries()["op13_alignment"](spark, small).collect()}
    assert got == dict(zip((i for i, _ in docs), aligned([t for _, t in docs])))


@pytest.mark.parametrize("hot", [5, 300_000])
def test_alignment_of_awkward_texts(spark, monkeypatch, hot):
    """Random mixtures of scripts, spaces, control strings and signs; null, repeated, very long; few pairs broadcast, and all."""
    r = random.Random(hot)
    parts = ["a", "the ", " ", "  ", "\n", "\t", "é", "日本", " x", "'s", "23", "😀", " ", "　", "<|endoftext|>", "</s>", "<s>", "<0x41>", "\x00", "\x85", ".", "ing", "\r\n", "ﬀ", "​", "▁", "̀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 40))) for _ in range(150)] + ["▁", " ", "  ", "x ▁ y", "a ", "x" * 5000]
    rows = [(i, t, "en", "s", 0, 1, 2, "c") for i, t in [*enumerate(texts, 100), *AWKWARD]]
    frame = spark.createDataFrame(rows, awkward(spark).schema).repartition(3)
    got = sorted(((r.doc_id or -1, numbers(r)) for r in alignment.alignment(frame, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), hot).collect()))
    assert got == sorted((i[0] or -1, x) for i, x in zip(rows, aligned([t for _, t, *_ in rows])))
    assert sum(x == (0, 0, 0, 0, 0, 0, "") for _, x in got) > 5
    assert alignment.alignment(empty(spark), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).count() == 0


def test_components_are_those_of_the_graph():
    r = random.Random(2)
    for _ in range(200):
        n = r.randrange(1, 30)
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(r.randrange(0, 40))]
        label = list(range(n))
        for _ in range(n):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        got = alignment.components(n, *(np.array([e[k] for e in edges], np.int64) for k in (0, 1)))
        assert got.tolist() == label


def test_slices_of_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 100)
    texts = pa.array(["x" * n for n in (10, 0, 95, 300, 5, 5, 90)] + [None])
    cuts = alignment.slices(texts)
    assert [i for lo, hi in cuts for i in range(lo, hi)] == list(range(8)) and all(sum(len(t or "") for t in texts.to_pylist()[lo:hi]) <= 100 + 300 for lo, hi in cuts)


# packing in the pipeline


def test_a_worker_drops_what_another_operator_kept():
    """Words of the packing held no more once a worker runs another operator's task, and no more than asked for."""
    from traceloom.llm import packing, vec

    path, texts = tokenizer("word_bpe_49k.json"), [[f"w{k}x{i}" for i in range(600)] for k in range(8)]
    whole, few = packing.WordCoder(path), vec.keep("few", lambda: packing.WordCoder(path, words=1000))
    for t in texts:
        assert few.code([" ".join(t)]) == whole.code([" ".join(t)])
        assert len(few.known) <= 1600 and len(few.older) <= 1600

    def other(batches):
        assert not vec._kept
        yield from batches

    def again(batches):
        vec.keep("few", lambda: 1)
        yield from batches

    assert list(vec.tidy(again)([1])) == [1] and vec._kept == {"few": 1}
    assert list(vec.tidy(again)([2])) == [2] and vec._kept == {"few": 1}
    assert list(vec.tidy(other)([3])) == [3]


# op10


def test_secrets_are_learnt_from_every_finding(spark, monkeypatch):
    """Access keys whose hashes are above those of 3,000 findings, among as many others and like unlabelled words."""
    r = np.random.default_rng(4)
    pick = lambda chars, n: "".join(r.choice(list(chars), n))
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = [(i, f"id {pick('0123456789abcdef', 32)} end" if i % 2 else f"see {pick(up, 24)} end") for i in range(7200)]
    own, free = [], iter(range(10_000, 10**6))
    while len(own) < 16:  # of the quarter that is not trained on, and as many others
        doc, key = next(free), "AKIA" + pick(up, 20)
        at = int.from_bytes(hashlib.blake2b(f"{doc}:4:{key}".encode(), digest_size=7).digest(), "big")
        if at > 0.95 * 2**56 and (at % 4 == 0) == (len(own) % 2 == 0):
            own.append((doc, f"see {key} end"))
    monkeypatch.setattr(secrets, "SHARD", 2500)
    monkeypatch.setattr(secrets, "EFFORT", 12_000)
    docs = spark.createDataFrame(rows + own, "doc_id long, text string")
    net, least = secrets.fit(docs.repartition(1))
    logits = net.logits([secrets.encode(t, 4, 28) for _, t in own[::2]])
    assert (logits >= least).all(), (logits, least)
    again, same = secrets.fit(docs.repartition(5))
    assert same == least and all((a == b).all() for a, b in zip((net.kernel, net.shift, net.out), (again.kernel, again.shift, again.out)))
