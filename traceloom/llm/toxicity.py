"""Toxicity by weak supervision.

Many voters (a fixed insult lexicon, word stems mined from labelled rows, and
patterns of use) vote on documents. A generative label model, fitted by
expectation maximisation, estimates every voter's rates in either class and the
voters' correlations given the class; its posterior labels train a linear
classifier, which scores every document.

Fitting reads a bounded sample of labelled rows (``max_positive`` and
``max_negative``); scoring reads every whole text.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import cut, small_side

# Common English insults.
LEXICON = ("airhead", "bastard", "bozo", "brainless", "clown", "coward", "creep", "cretin", "dimwit", "disgusting", "dumb", "dumbass", "dunce", "fool", "freak", "garbage", "halfwit", "idiot", "imbecile", "jerk", "liar", "loser", "lowlife", "maggot", "moron", "nitwit", "pathetic", "pig", "psycho", "scum", "scumbag", "sleazy", "stupid", "swine", "trash", "twit", "vermin", "vile", "weirdo", "worthless")
PATTERNS = ("two distinct hits", "three distinct hits", "five hits", "a hit in a hundred words", "two hits within ten words", "no hit")
EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*%$#&+-_/\\~`^=@0123456789"
STEMS = range(3, 9)
SEEN_WORDS = 150_000


@dataclass
class Model:
    """Voters, whole words first, and the linear classifier over votes and patterns."""

    words: dict[str, int]
    stems: dict[str, int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    rates: np.ndarray | None = None  # of each voter, in clean and in toxic documents
    correlations: np.ndarray | None = None


class Voter:
    """Votes of one text. Words without any vote are remembered, up to SEEN_WORDS."""

    def __init__(self, words: dict[str, int], stems: dict[str, int]):
        self.words, self.stems, self.n = words, stems, len(words) + len(stems)
        self.mute: set[str] = set()
        self.loud: dict[str, list[int]] = {}

    def of_word(self, raw: str) -> list[int]:
        w = raw.strip(EDGES)
        found = [self.words[w]] if w in self.words else []
        return found + [self.stems[w[:k]] for k in STEMS if len(w) >= k and w[:k] in self.stems]

    def votes(self, text: str | None) -> tuple[list[int], list[int]]:
        """Voters that vote, and of the patterns 1 or 0."""
        tokens = (text or "").lower().split()
        for w in set(tokens).difference(self.mute):
            if w not in self.loud:
                if v := self.of_word(w):
                    self.loud[w] = v
                else:
                    self.mute.add(w)
        if len(self.mute) > SEEN_WORDS:
            self.mute.clear()
        hot = set(tokens).intersection(self.loud)
        if not hot:
            return [], [0, 0, 0, 0, 0, 1]
        voters = sorted({v for w in hot for v in self.loud[w]})
        at = [i for i, w in enumerate(tokens) if w in hot]
        near = any(b - a <= 10 for a, b in zip(at, at[1:]))
        return voters, [int(len(hot) >= 2), int(len(hot) >= 3), int(len(at) >= 5), int(100 * len(at) >= len(tokens)), int(near), 0]


def _sample(docs: DataFrame, labels: DataFrame, max_positive: int, max_negative: int) -> DataFrame:
    """At most so many labelled rows of either class that are not held out, by a hash of doc_id."""
    learn = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2"))
    learn = learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = learn.where("toxic = 1").orderBy(*order).limit(max_positive).union(learn.where("toxic = 0").orderBy(*order).limit(max_negative))
    some = cut(some.select(F.col("doc_id").alias("__id"), "toxic"))
    return docs.select(F.col("doc_id").cast("long"), "text").join(small_side(some), F.col("doc_id") == F.col("__id")).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))


def _apart(sample: DataFrame) -> DataFrame:
    """``sample`` with one of the rows that share the least hash of three words, as near copies do."""

    def least(batches):
        for b in batches:
            keys = np.zeros(b.num_rows, np.int64)
            for w in vec.words(b.column(1), lower=True):
                at, h = vec.windows(w, 3)
                edges = np.searchsorted(at, w.first)
                for r in range(w.hi - w.lo):
                    own = h[edges[r] : edges[r + 1]]
                    keys[w.lo + r] = own.min().astype(np.int64) if len(own) else b.column(0)[w.lo + r].as_py()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys)], ["doc_id", "text", "toxic", "key"])

    keyed = sample.mapInArrow(vec.tidy(least), "doc_id long, text string, toxic int, key long")
    return keyed.groupBy("key", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("least")).select("least.doc_id", "least.text", "toxic")


def _mine(sample: DataFrame, least: int) -> tuple[list[str], list[str]]:
    """All words and stems that toxic sample rows hold and clean ones all but never do.

    A stem must begin several different words, and adds nothing where a chosen
    word or stem is in as many rows; nor does a word whose stem is chosen. What
    is collected is bounded by the sample's toxic texts.
    """

    def count(batches):
        counts, forms = (Counter(), Counter()), {}
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {w for w in (x.strip(EDGES) for x in set((text or "").lower().split())) if len(w) > 2}
                counts[toxic].update(own)
                counts[toxic].update({"^" + w[:k] for w in own for k in STEMS if len(w) > k})
                for w in own if toxic else ():
                    for k in STEMS:
                        if len(w) > k:
                            forms.setdefault("^" + w[:k], set()).add(w)
        for toxic, c in enumerate(counts):
            some = list(c.items())
            for i in range(0, len(some), 100_000):
                k, n = zip(*some[i : i + 100_000])
                zero, kinds = pa.array([0] * len(k), pa.int64()), pa.array([len(forms.get(x, " ")) if toxic else 0 for x in k], pa.int64())
                n = pa.array(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), n if toxic else zero, zero if toxic else n, kinds], ["term", "pos", "neg", "forms"])

    schema = "term string, pos long, neg long, forms long"
    terms = sample.select("text", "toxic").mapInArrow(vec.tidy(count), schema).groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("forms").alias("forms"))
    strong = (F.col("pos") >= least) & (F.col("pos") >= 50 * F.col("neg")) & (~F.col("term").startswith("^") | (F.col("forms") >= 3))
    words: list[str] = []
    stems: dict[str, int] = {}
    rows: dict[str, int] = {}
    for r in terms.where(strong).orderBy(F.desc("pos"), F.length("term"), "term").collect():
        stem = r.term[1:] if r.term[0] == "^" else None
        if stem is None:
            if any(r.term[:k] in stems for k in STEMS):
                continue
            words.append(r.term)
            rows[r.term] = r.pos
        elif not any(stem[:k] in stems for k in STEMS) and not any(w.startswith(stem) and 10 * n >= 9 * r.pos for w, n in rows.items()):
            stems[stem] = r.pos
    return words, list(stems)


def label_model(votes: np.ndarray, labels: np.ndarray | None, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxic for each row, rates (voters, 2) and correlations of voters given the class.

    EM over a two-class mixture of Bernoulli voters. Known labels only start
    it. Each voter's evidence is divided by one plus its positive correlations
    with the others, so that voters who repeat one another count once.
    """
    n, k = votes.shape
    start = votes.any(1).astype(float) if labels is None else labels.astype(float)
    post, spread = 0.9 * start + 0.05, np.ones(k)
    rates, near = np.full((k, 2), 0.5), np.zeros((k, k))
    for r in range(rounds):
        prior = min(max(post.mean(), 1e-3), 1 - 1e-3)
        rates = np.stack([((1 - post) @ votes + 0.05) / ((1 - post).sum() + 1), (post @ votes + 0.05) / (post.sum() + 1)], 1)
        if r % 5 == 0:
            mean = np.outer(1 - post, rates[:, 0]) + np.outer(post, rates[:, 1])
            rest = votes - mean
            cov = rest.T @ rest / n
            sd = np.sqrt(np.maximum(cov.diagonal(), 1e-9))
            near = cov / np.outer(sd, sd)
            spread = np.maximum(near - np.eye(k), 0).sum(1) + 1
        log = np.log(rates) / spread[:, None]
        off = np.log(1 - rates) / spread[:, None]
        odds = np.log(prior / (1 - prior)) + votes @ (log[:, 1] - log[:, 0]) + (1 - votes) @ (off[:, 1] - off[:, 0])
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, rates, near


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights and, last, bias of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w, keep = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
    return w


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_negative: int = 6000, threshold: float = 0.3) -> Model:
    """The model, from at most ``max_positive + max_negative`` labelled rows.

    Without labelled rows the lexicon votes alone and the label model starts
    from its votes.
    """
    sample = cut(_apart(_sample(docs, labels, max_positive, max_negative)))
    words, stems = _mine(sample, 4)
    names = list(dict.fromkeys([*LEXICON, *words]))
    of_word = {w: i for i, w in enumerate(names)}
    of_stem = {s: len(names) + i for i, s in enumerate(stems)}
    k = len(of_word) + len(of_stem)

    def vote(batches):
        v = Voter(of_word, of_stem)
        for b in batches:
            rows = [(t, *v.votes(x)) for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if rows:
                kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["toxic", "voters", "patterns"])

    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(vec.tidy(vote), "toxic int, voters array<int>, patterns array<int>").collect()  # bounded by the sample
    votes, y = np.zeros((len(rows), k + len(PATTERNS))), np.zeros(len(rows))
    for i, (toxic, voters, patterns) in enumerate(rows):
        votes[i, voters] = 1
        votes[i, k:] = patterns
        y[i] = toxic
    if not len(rows):  # nothing to learn from: every lexicon word is weak evidence
        weights = np.concatenate([np.full(k, 0.8), [1, 1, 1, 0.5, 0.5, -1]])
        return Model(of_word, of_stem, weights, -2.5)
    post, rates, near = label_model(votes, y if y.any() else None)
    w = _logistic(votes, post)
    # Shift so that the cut that best parts the sample's labels falls on the threshold.
    odds = votes @ w[:-1] + w[-1]
    order = np.argsort(-odds, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(odds[order][1:] < odds[order][:-1], True)
    best = int(np.where(last, f1, -1).argmax())
    nxt = odds[order[best + 1]] if best + 1 < len(y) else odds[order[best]] - 2
    shift = np.log(threshold / (1 - threshold)) - (odds[order[best]] + nxt) / 2 if y.any() else 0.0
    return Model(of_word, of_stem, w[:-1], float(w[-1] + shift), rates, near)


def _scorer(model: Model, docs: DataFrame):
    """A function for tasks: of texts, scores and the number of voters that vote."""
    own = docs.sparkSession.sparkContext.broadcast((model.words, model.stems, model.weights, model.bias))

    def start():
        words, stems, weights, bias = own.value
        v = Voter(words, stems)

        def score(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            out, hits = np.empty(len(column)), np.empty(len(column), np.int32)
            for lo in range(0, len(column), 256):
                for i, text in enumerate(column.slice(lo, 256).to_pylist(), lo):
                    voters, patterns = v.votes(text)
                    out[i] = bias + weights[voters].sum() + weights[v.n :] @ patterns
                    hits[i] = len(voters)
            return 1 / (1 + np.exp(-np.clip(out, -30, 30))), hits

        return score

    return start


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits) of every document.

    Rows whose crc32(doc_id as text) mod 4 is 2 are held out of learning. Null
    counts as empty; empty texts get the score of a text without any vote.
    Repeated rows are each scored; a null doc_id is kept and not held out. No
    documents give no rows. Only doc_id and text, and of labels doc_id and
    toxic, are read.
    """
    start = _scorer(model or fit(docs, labels, threshold=threshold), docs)

    def run(batches):
        scores = start()
        for b in batches:
            score, hits = scores(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(hits)], ["doc_id", "score", "predicted", "n_hits"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(vec.tidy(run), "doc_id long, score double, predicted int, n_hits int")
    held = F.coalesce(F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "n_hits")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic; all columns stay.

    Every row is judged by its own text and passed on or not where it is read,
    so null and repeated doc_ids, and columns of any name, need no care. Null
    and empty texts are never toxic by a vote. No rows give no rows.
    """
    start, text = _scorer(fit(docs, labels, threshold=threshold), docs), docs.columns.index("text")

    def run(batches):
        scores = start()
        for b in batches:
            yield b.filter(pa.array(scores(b.column(text))[0] < threshold))

    return docs.mapInArrow(vec.tidy(run), docs.schema)
