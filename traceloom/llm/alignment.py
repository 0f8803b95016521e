"""Cross-tokenizer alignment: minimal groups of tokens that two tokenizers cut alike, and how often their ids meet.

Tokens of both tokenizers are the nodes of a bipartite graph, whose edges join
tokens with overlapping bytes. Union-find gives its connected components: the
minimal groups between byte offsets where both tokenizers end a token. Edges
are the links. Texts are cut into chunks that neither tokenizer merges across,
and a batch's distinct chunks are coded and aligned once.

A task writes one row a document with its distinct linked id pairs; pairs are
then counted over all documents and joined back to the documents' pairs.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import shared_folder

#: Bytes of text aligned at once; a longer text is aligned alone.
SLICE = 1 << 22
#: Bytes given to a tokenizer as one string, and how many such strings at once.
BLOCK, FEW = 1 << 15, 4
#: Pairs that are broadcast: the ones in most documents.
HOT_PAIRS = 300_000
SPACE_MARK = "▁"
LINKS = "array<struct<a: int, b: int, n: int>>"
ROW = f"row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links {LINKS}"


class ByteLevel:
    """A byte-level BPE of the tokenizers library, special tokens' strings as plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}  # the byte-level alphabet
        self.token = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        for text, i in self.model.get_vocab(with_added_tokens=False).items():
            self.token[i] = bytes(map(back.__getitem__, text))
        self.sizes = np.array([len(t) for t in self.token], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        few = (texts[i : i + FEW] for i in range(0, len(texts), FEW))  # what the library returns takes some hundred bytes a token
        return [e.ids for some in few for e in self.model.encode_batch(some, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model that puts a space before its text; texts come with that space."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = sp = SentencePieceProcessor(model_file=path)
        self.space = sp.piece_to_id(SPACE_MARK)
        names = sp.id_to_piece(list(range(sp.get_piece_size())))
        self.token = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(names)]
        self.sizes = np.array([len(t) for t in self.token], np.int64)
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names):
            raise ValueError("pieces that go on after a space can't be aligned in chunks")

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [x if x or t != " " else [self.space] for x, t in zip(ids, texts)]  # an empty text would get no token


@functools.cache
def tokenizers(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    """Loaded once in a Python worker."""
    return ByteLevel(a), Pieces(b)


def find(parent: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Roots of ``node``, halving paths on the way."""
    while True:
        up = parent[node]
        over = parent[up]
        if np.array_equal(up, over):
            return up
        parent[node] = over
        node = over


def components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least node of every node's component, over the edges left[i] - right[i]."""
    parent = np.arange(n)
    while len(left):
        l, r = find(parent, left), find(parent, right)
        apart = l != r
        left, right, l, r = left[apart], right[apart], l[apart], r[apart]
        np.minimum.at(parent, np.maximum(l, r), np.minimum(l, r))  # the larger root goes under the least it meets
    return find(parent, np.arange(n))


@dataclass
class Coded:
    """Tokens of a list of chunks: ids, byte lengths, the first token of each chunk, and whether its bytes are the chunk's."""

    ids: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    whole: np.ndarray


def code(tokenizer, data: bytes, edges: np.ndarray, safe: np.ndarray) -> Coded:
    """Tokens of the chunks data[edges[i]:edges[i + 1]].

    Neighbours go to the tokenizer as one string while all but the last of them
    are ``safe``: end so that no token goes on into a chunk after it. Where a
    string's tokens do not give its bytes back, its chunks are coded alone.
    """
    n, token = len(edges) - 1, tokenizer.token
    ends = np.flatnonzero(~safe | (np.diff(edges // BLOCK) > 0)) + 1
    blocks = np.unique([0, *ends.tolist(), n]).tolist()
    blocks = list(zip(blocks, blocks[1:]))
    part = lambda lo, hi: data[edges[lo] : edges[hi]]
    coded = lambda blocks: zip(blocks, tokenizer.encode([part(*b).decode("utf-8", "surrogatepass") for b in blocks]))
    back = lambda ids: b"".join(map(token.__getitem__, ids))
    good, again = {}, []
    for (lo, hi), ids in coded(blocks):
        if back(ids) == part(lo, hi):
            good[lo] = ids
        else:
            again += [(i, i + 1) for i in range(lo, hi)]
    whole = np.ones(n, bool)
    for (lo, hi), ids in coded(again):
        whole[lo] = back(ids) == part(lo, hi)
        good[lo] = ids if whole[lo] else []
    parts = [np.array(good[lo], np.int64) for lo in sorted(good)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    sizes = tokenizer.sizes[ids]
    upto = np.zeros(n + 1, np.int64)
    np.cumsum(np.where(whole, np.diff(edges), 0), out=upto[1:])
    stops = np.cumsum(sizes)
    first = np.searchsorted(stops, upto, "right")
    if not np.array_equal(np.append(0, stops)[first], upto):
        raise ValueError("a token goes on into the next chunk")
    return Coded(ids, sizes, first, whole)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct values of two ascending arrays, ascending."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return both[np.append(True, both[1:] != both[:-1])] if len(both) else both


def chunks(at: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of chunks, first chunk of each text) of texts that begin with a space.

    A chunk begins at a space after an ASCII character that is no white space.
    """
    graphic = (data > 32) & (data < 127)
    cuts = np.flatnonzero(graphic[:-1] & (data[1:] == 32)) + 1
    edges = merged(cuts, at)
    return edges, np.searchsorted(edges, at)


@functools.cache
def numerals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each number under ``n``: its digits from the right end of a row, and how many they are."""
    width, ids = len(str(n)), np.arange(n)[:, None]
    return (ids // 10 ** np.arange(width - 1, -1, -1) % 10 + 48).astype(np.uint8), np.maximum((ids >= 10 ** np.arange(width)).sum(1), 1)


def decimal(ids: np.ndarray, marks: np.ndarray, n: int) -> tuple[bytes, np.ndarray]:
    """Each id, under ``n``, in decimal with its mark after it; and where each begins, with the end."""
    digits, some = numerals(n)
    width, some = digits.shape[1], some[ids]
    text = np.empty((len(ids), width + 1), np.uint8)
    text[:, :width], text[:, width] = digits[ids], marks
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(some + 1, out=at[1:])
    return text[np.arange(width + 1) >= (width - some)[:, None]].tobytes(), at


@dataclass
class Aligned:
    """Of each chunk: numbers of tokens, groups and links, the groups' text; and all links with the first of each chunk."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    first: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    text: list[bytes]


def align(a: Coded, b: Coded, n_ids: int) -> Aligned:
    """Components and links of chunks; those that are not whole in both have none."""
    whole = a.whole & b.whole
    n = len(whole)

    def of(c: Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chunk = np.repeat(np.arange(n), np.diff(c.first))
        good = whole[chunk]
        return chunk[good], c.ids[good], np.cumsum(c.sizes[good])

    chunk_a, ids_a, ends_a = of(a)
    chunk_b, ids_b, ends_b = of(b)
    # Between neighbouring ends of any token lies one token of each: a link.
    ends = merged(ends_a, ends_b)
    left, right = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    roots = components(len(ids_a) + len(ids_b), left, right + len(ids_a))
    heads = np.zeros(len(roots), bool)
    heads[roots] = True
    group = (np.cumsum(heads) - 1)[roots]  # a root is a component's first token of A, so groups come in order
    group_a, group_b = group[: len(ids_a)], group[len(ids_a) :]
    n_group = int(group.max(initial=-1)) + 1
    group_chunk = np.zeros(n_group, np.int64)
    group_chunk[group_a] = chunk_a
    # A group's tokens of A, then those of B, each followed by its mark.
    in_a, in_b = np.bincount(group_a, minlength=n_group), np.bincount(group_b, minlength=n_group)
    at_a = np.arange(len(ids_a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(ids_b)) + np.cumsum(in_a)[group_b]
    ids, marks, chunk = np.zeros(len(group), np.int64), np.full(len(group), ord(",")), np.zeros(len(group), np.int64)
    ids[at_a], ids[at_b], chunk[at_a], chunk[at_b] = ids_a, ids_b, chunk_a, chunk_b
    last = np.cumsum(in_a + in_b)
    marks[last - 1], marks[last - in_b - 1] = ord(";"), ord("|")
    raw, at = decimal(ids, marks, n_ids)
    cuts = at[np.searchsorted(chunk, np.arange(n + 1))].tolist()
    return Aligned(whole, np.bincount(chunk_a, minlength=n), np.bincount(chunk_b, minlength=n), np.bincount(group_chunk, minlength=n), np.searchsorted(chunk_a[left], np.arange(n + 1)), ids_a[left], ids_b[right], [raw[x:y] for x, y in zip(cuts, cuts[1:])])


def spread(first: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the picked runs first[i]:first[i + 1], one run after the other; and each run's length."""
    sizes = first[picks + 1] - first[picks]
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first[picks] - before, sizes), sizes


def digest(texts: pa.Array, a: ByteLevel, b: Pieces) -> list[pa.Array]:
    """Columns n_a to links of ROW."""
    n = len(texts)
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_utf8()), pc.fill_null(texts.cast(pa.large_utf8()), ""), pa.scalar("", pa.large_utf8()))
    at, data = vec.binary(spaced)
    data = data[at[0] : at[-1]]
    edges, doc_first = chunks(at - at[0], data)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
    own, raw = vec.binary(coded.dictionary)
    index = np.asarray(coded.indices, np.int64)
    joined = raw[own[0] : own[-1]]
    own = own - own[0]
    ends = joined[own[1:] - 1]
    safe = (ends > 32) & (ends < 127)
    joined = joined.tobytes()
    got = align(code(a, joined, own, safe), code(b, joined, own, safe), max(len(a.token), len(b.token)))

    of_doc = np.repeat(np.arange(n), np.diff(doc_first))
    good = np.ones(n, bool)
    good[of_doc[~got.whole[index]]] = False
    good[np.diff(at) == 1] = False  # the added space alone
    index, of_doc = index[good[of_doc]], of_doc[good[of_doc]]
    total = lambda x: np.bincount(of_doc, x[index], n).astype(np.int64)
    cuts = np.searchsorted(of_doc, np.arange(n + 1)).tolist()
    picks, part = index.tolist(), got.text.__getitem__
    sha = [hashlib.sha256(b"".join(map(part, picks[lo:hi]))[:-1]).hexdigest() if ok else "" for lo, hi, ok in zip(cuts, cuts[1:], good.tolist())]

    kinds, kind = np.unique(got.link_a << 32 | got.link_b, return_inverse=True)
    links, sizes = spread(got.first, index)
    both = np.repeat(of_doc, sizes) * max(len(kinds), 1) + kind[links]
    both, times = np.unique(both, return_counts=True)
    doc, pair = both // max(len(kinds), 1), kinds[both % max(len(kinds), 1)] if len(kinds) else both
    offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
    items = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (pair >> 32, pair & 0xFFFFFFFF, times)], ["a", "b", "n"])
    counts = [pa.array(x) for x in (total(got.n_a), total(got.n_b), total(got.n_groups), total(np.diff(got.first)))]
    return [*counts, pa.array(sha, pa.string()), pa.ListArray.from_arrays(offsets, items)]


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs of rows of about SLICE bytes."""
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(texts)]
    return [(lo, hi) for lo, hi in zip(edges, edges[1:]) if hi > lo]


def document_links(docs: DataFrame, a: str, b: str) -> DataFrame:
    """ROW of every document; ``links`` are its distinct linked id pairs with their numbers of links.

    ``row`` is unique once the rows are written. Texts that are null, empty, or
    not given back byte for byte by both tokenizers have no tokens.
    """

    def run(batches):
        both, row = tokenizers(a, b), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in slices(texts):
                columns = digest(texts.slice(lo, hi - lo), *both)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + hi - lo)), ids.slice(lo, hi - lo), *columns], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])
                row += hi - lo

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(vec.tidy(run), ROW)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, documents, best) of every linked id pair: in how many documents, and whether that is the most of its ``a``."""
    pairs = linked.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("documents"))
    top = pairs.groupBy("a").agg(F.max("documents").alias("most"))  # one row a token id of A at most
    return pairs.join(top, "a").select("a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, a: str, b: str, hot: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``a`` is a byte-level BPE file, ``b`` a sentencepiece model. Documents
    without tokens (see ``document_links``) have zeros and an empty digest.
    Rows that repeat are documents of their own, in counts and result; a null
    doc_id is kept; no documents give no rows. A text is held whole in a task.
    Only doc_id and text are read.

    The ``hot`` pairs in most documents are broadcast, a number that no input
    changes; documents' other pairs are joined by shuffle.
    """
    spark = docs.sparkSession
    base = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    document_links(docs, a, b).write.option("compression", "zstd").parquet(f"{base}/links")
    linked = spark.read.schema(ROW).parquet(f"{base}/links")
    pair_counts(linked).write.parquet(f"{base}/pairs")
    pairs = spark.read.schema("a int, b int, documents long, best boolean").parquet(f"{base}/pairs")
    top = pairs.orderBy(F.desc("documents"), "a", "b").limit(hot)
    top.write.parquet(f"{base}/top")
    top = spark.read.schema(pairs.schema).parquet(f"{base}/top")
    each = linked.select("row", F.inline("links")).join(F.broadcast(top), ["a", "b"], "left")
    sums = [F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("documents") * F.col("n")).alias("count_sum")]
    known = each.where("documents IS NOT NULL").groupBy("row").agg(*sums)
    if pairs.count() > hot:
        rest = pairs.join(F.broadcast(top.select("a", "b")), ["a", "b"], "left_anti")
        other = each.where("documents IS NULL").select("row", "a", "b", "n").join(rest, ["a", "b"]).groupBy("row").agg(*sums)
        known = known.unionByName(other).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return linked.drop("links").join(known, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
