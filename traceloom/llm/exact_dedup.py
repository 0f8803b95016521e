"""Exact dedup: compressed radix tries own every distinct text.

Each map task keeps a trie of the texts it reads and sends one row per
distinct text, with the owner and the number of rows, so a text that a third
of the table repeats leaves a task once. Rows meet by (length, content hash);
there a second trie compares full byte strings and its terminal nodes store the
owner. A trie that outgrows its memory spills whole subtrees to files in Spark's
scratch folder, which are replayed one at a time within the same task; if the
executor is lost, the task and its files begin anew.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.llm import vec
from traceloom.session import cut, lookup, skew_join, width

CLASS_SCHEMA = "length long, text_sha256 string, keep_id long, group_size long, owner_rows long"
PART_SCHEMA = CLASS_SCHEMA + ", body binary"


class Node:
    """``owners`` of the ``rows`` rows have the identifier ``owner``."""

    __slots__ = ("children", "label", "owner", "owners", "rows", "tag")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.owners, self.rows, self.tag = label, None, None, 0, 0, None


def _common(key: bytes, at: int, label: bytes) -> int:
    """Length of the longest prefix of ``label`` that ``key`` has at ``at``."""
    lo, hi = 0, min(len(label), len(key) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if key.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _cost(node: Node) -> int:
    return len(node.label) + 300


class PatriciaTrie:
    """Byte strings to (owner, owners, rows, tag). All strings begin with ``lead``.

    ``keep`` is ``max`` or ``min``: which identifier owns a string. A null
    identifier owns only strings that have no other. Beyond ``limit`` bytes the
    largest subtree goes to a file in the folder where Spark's own spills go,
    and later strings under its lead follow it. No lead of a file lies under
    another's, so every string is in one place.
    """

    def __init__(self, keep=max, limit: int = 128 << 20, lead: bytes = b""):
        self.keep, self.limit, self.lead = keep, limit, lead
        self.clear()

    def clear(self) -> None:
        self.root, self.size, self.spilled = Node(b""), 0, {}

    def insert(self, key: bytes, owner: int | None, owners: int, rows: int, tag: str) -> None:
        node, at = self.root, len(self.lead)
        while at < len(key):
            child = node.children.get(key[at]) if node.children else None
            if child is None:
                if self.spilled and (out := self._file_of(key)):
                    pickle.dump((key, owner, owners, rows, tag), out)
                    return
                child = Node(key[at:])
                node.children = node.children or {}
                node.children[key[at]] = child
                self.size += _cost(child)
                node, at = child, len(key)
                break
            n = _common(key, at, child.label)
            if n < len(child.label):
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children = {child.label[0]: child}
                node.children[key[at]] = upper
                self.size += 300
                child = upper
            node, at = child, at + n
        if node.rows == 0:
            node.owner, node.owners = owner, owners
        elif owner == node.owner:
            node.owners += owners
        elif owner is not None and (node.owner is None or self.keep(owner, node.owner) == owner):
            node.owner, node.owners = owner, owners
        node.rows, node.tag = node.rows + rows, tag
        if self.size > self.limit:
            self._spill()

    def _file_of(self, key: bytes):
        return next((self.spilled[key[:n]] for n in self._lengths if key[:n] in self.spilled), None)

    def _spill(self) -> None:
        node, lead = self.root, self.lead
        while node.children and len(node.children) == 1 and not node.rows:
            node = next(iter(node.children.values()))
            lead += node.label
        if not node.children:
            return  # one string alone: nothing to set aside
        sizes = {b: sum(_cost(n) for _, n in self._walk(c, b"", False)) for b, c in node.children.items()}
        most = max(sizes, key=sizes.get)
        under = lead + bytes([most])
        out = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)  # unlinked at once: a lost task leaves nothing
        for deeper in [x for x in self.spilled if x.startswith(under)]:
            old = self.spilled.pop(deeper)
            old.seek(0)
            shutil.copyfileobj(old, out)
            old.close()
        for rest, n in self._walk(node.children.pop(most), lead, True):
            pickle.dump((rest, n.owner, n.owners, n.rows, n.tag), out)
        self.spilled[under] = out
        self._lengths = sorted({len(x) for x in self.spilled})
        self.size -= sizes[most]

    def _walk(self, node: Node, path: bytes, spell: bool) -> Iterator[tuple[bytes, Node]]:
        """Nodes below and with ``node``; with ``spell`` those that end a string, and their strings."""
        stack = [(node, path)]
        while stack:
            node, path = stack.pop()
            if spell:
                path += node.label
            if node.rows or not spell:
                yield path, node
            stack += [(c, path) for c in (node.children or {}).values()]

    def items(self) -> Iterator[tuple[bytes, Node]]:
        """Every string once, with its terminal node; spilled subtrees come last."""
        yield from self._walk(self.root, self.lead, True)
        files, _ = self.spilled, self.clear()
        for lead, out in files.items():
            part = PatriciaTrie(self.keep, self.limit, lead)
            out.seek(0)
            while True:
                try:
                    part.insert(*pickle.load(out))
                except EOFError:
                    break
            out.close()
            yield from part.items()


def _rows(found: Iterator[tuple[bytes, Node]], with_body: bool, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    names = ["length", "text_sha256", "keep_id", "group_size", "owner_rows"] + ["body"] * with_body
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_body
    rows, held = [], 0
    for key, node in found:
        rows.append((len(key), node.tag, node.owner, node.rows, node.owners) + (key,) * with_body)
        held += len(key) * with_body + 100
        if held > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", memory: int = 96 << 20) -> DataFrame:
    """One row per distinct text: length in bytes, text_sha256, keep_id, group_size, owner_rows.

    ``owner_rows`` of the ``group_size`` rows have the owner's identifier.
    ``memory`` bounds a task's trie in bytes.
    """
    best = {"max": max, "min": min}[keep]

    def gather(batches):
        trie = PatriciaTrie(best, 2 * memory)
        for b in batches:
            at, data = vec.binary(b.column(1))
            for i, doc in enumerate(b.column(0).to_pylist()):
                key = data[at[i] : at[i + 1]].tobytes()
                trie.insert(key, doc, 1, 1, hashlib.sha256(key).hexdigest())
                if trie.size > memory:
                    yield from _rows(trie.items(), True)
                    trie.clear()
        yield from _rows(trie.items(), True)

    def merge(batches):
        trie = PatriciaTrie(best, memory)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                for _, tag, owner, rows, owners, key in zip(*(c.slice(lo, 256).to_pylist() for c in b.columns)):
                    trie.insert(key, owner, owners, rows, tag)
        yield from _rows(trie.items(), False)

    parts = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(vec.tidy(gather), PART_SCHEMA)
    return parts.repartition(width(docs.sparkSession), "length", "text_sha256").mapInArrow(vec.tidy(merge), CLASS_SCHEMA)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", memory: int = 96 << 20) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every document.

    Texts are equal when their bytes are; null counts as empty, and empty texts
    are equal to each other. Rows that repeat both id and text stay or go
    together. A null id never owns a text that a document with an id has. No
    rows give no rows. Only the id and text columns are read, so other columns
    may have any name.
    """
    classes = cut(text_classes(docs, id_col, text_col, keep, memory)).select("text_sha256", "keep_id", "group_size")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256"))
    found = skew_join(ids, classes, ["text_sha256"], "group_size")
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first_copies(docs: DataFrame, keep: str = "max") -> DataFrame:
    """One row of ``docs`` for every distinct text: that of the largest (or smallest) doc_id. All columns stay.

    A text is never lost: rows that share a doc_id but not the text are judged
    each on its own, and a text that has null ids alone keeps one row. Of rows
    equal in id and text the least by its JSON stays. Null and empty texts are
    one text. No rows give no rows. Columns may have any name; they travel in a
    struct.
    """
    classes = cut(text_classes(docs, keep=keep).where("group_size > 1").select(F.col("text_sha256").alias("sha"), "keep_id", "group_size", "owner_rows"))
    rows = docs.select(F.struct("*").alias("row"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), F.col("doc_id").cast("long").alias("id"))
    found = lookup(rows, classes, ["sha"], "group_size", "left").where("group_size IS NULL OR id <=> keep_id")
    several = F.coalesce("owner_rows", F.lit(1)) > 1
    single = found.where(~several).select("row")
    one_of = found.where(several).groupBy("sha").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return single.union(one_of).select("row.*")
