"""Line deduplication by keep bitmaps, over ranges of line hashes.

DataFrame functions only. Every line travels as two independent 64-bit hashes
of its key with its document and position, never as text. Hashes are dealt in
equal ranges, which need no sample since hashes are even, and sorted by
document and position in them; a pass along that order marks each key's first
line in every document and counts its documents. A document gets back which of
its lines stay, as run lengths.

The keys in most documents are known beforehand from a tally that is combined
before its shuffle. Their rows are dealt to cells by document, over all ranges,
and take the number of documents from the tally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import width

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys whose rows are dealt by document; the number bounds what is broadcast.
HOT_KEYS = 1000
#: Documents that a cell of such a key has at least.
CELL_DOCS = 100
#: Documents whose lines make a range.
RANGE_DOCS = 20_000
#: End of a run that goes on to the end of its text.
OPEN = 2**31 - 1


def text_lines(text: str = "text") -> Column:
    """Lines of a text column, parted by line feeds; null and empty texts have one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def bare(line: Column) -> Column:
    """The line without white space at its ends."""
    return F.btrim(line, F.lit(BLANK))


def line_key(line: Column) -> Column:
    """The bare line with A-Z lower-cased.

    ``lower`` changes other letters too, so it only serves lines of ASCII alone.
    """
    line = bare(line)
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, body, at, k1, k2) of every line whose key has ``min_chars`` code points or more."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("body"), text_lines().alias("lines"))  # hashed here, once a text, not once a line
    lines = lines.select("doc_id", "body", F.posexplode("lines").alias("at", "line")).where(F.length(bare(F.col("line"))) >= min_chars)
    keyed = lines.select("doc_id", "body", "at", line_key(F.col("line")).alias("key"))
    return keyed.select("doc_id", "body", "at", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def hot_keys(docs: DataFrame, min_chars: int, limit: int) -> DataFrame:
    """(k1, n, first): the ``limit`` keys in the most documents, their number, and the least (doc_id, body) of them.

    A document's keys are made distinct within its row, and equal keys of a
    task are one row before the shuffle.
    """
    keys = F.transform(F.filter(text_lines(), lambda x: F.length(bare(x)) >= min_chars), lambda x: F.xxhash64(line_key(x)))
    own = docs.select("doc_id", F.xxhash64("text").alias("body"), F.array_distinct(keys).alias("keys")).select("doc_id", "body", F.explode("keys").alias("k1"))
    tally = own.groupBy("k1").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "body")).alias("first"))
    return tally.orderBy(F.desc("n"), "k1").limit(limit)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, limit: int = HOT_KEYS, ranges: int | None = None) -> DataFrame:
    """(doc_id, body, keep_runs, n_dropped) of the documents that lose a line.

    Keys found in ``min_docs`` documents or more lose all their lines, or with
    ``keep_first`` all but the first one by doc_id and position. ``keep_runs``
    is the bitmap of kept lines in compressed form: (start, length) of each run
    of them, where the last has length ``OPEN`` if it goes to the text's end.
    ``body`` is a hash of the text, so that rows that share a doc_id have
    bitmaps of their own.
    """
    ranges = ranges or max(width(docs.sparkSession), docs.count() // RANGE_DOCS)
    hot = F.broadcast(hot_keys(docs, min_chars, limit))
    cells = F.least(F.lit(ranges), F.ceil(F.col("n") / CELL_DOCS))
    occ = _occurrences(docs, min_chars).join(hot, "k1", "left")
    occ = occ.withColumn("cell", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id", "body"), cells)))
    part = F.shiftright(F.shiftrightunsigned("k1", 40) * ranges, 24)
    dealt = occ.withColumn("range", F.pmod(part + F.col("cell"), F.lit(ranges)).cast("int")).repartitionById(ranges, "range")
    key = ["range", "k1", "k2", "cell"]
    own = F.rank().over(Window.partitionBy(*key, "doc_id", "body").orderBy("at"))
    along = Window.partitionBy(*key).orderBy("doc_id", "body", "at")
    seen = dealt.withColumn("starts", (own == 1).cast("int"))
    seen = seen.withColumn("docs", F.coalesce("n", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    if keep_first:
        leads = F.rank().over(along) == 1
        seen = seen.withColumn("leads", leads & (F.col("n").isNull() | F.struct("doc_id", "body").eqNullSafe(F.col("first"))))
    gone = seen.where(F.col("docs") >= min_docs)
    if keep_first:
        gone = gone.where(~F.col("leads"))
    gone = gone.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set("at")).alias("at"))
    # Dropped runs begin where the line before stays and end where the next one does; kept runs lie between.
    begins = F.expr("filter(at, (x, i) -> i = 0 OR get(at, i - 1) < x - 1)")
    ends = F.expr("transform(filter(at, (x, i) -> i = size(at) - 1 OR get(at, i + 1) > x + 1), x -> x + 1)")
    runs = gone.select("doc_id", "body", begins.alias("b"), ends.alias("e"), F.size("at").cast("long").alias("n_dropped"))
    kept = f"transform(array_insert(e, 1, 0), (x, i) -> named_struct('start', x, 'length', coalesce(get(b, i), {OPEN}) - x))"
    return runs.select("doc_id", "body", F.filter(F.expr(kept), lambda r: r["length"] > 0).alias("keep_runs"), "n_dropped")


def _beside(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as alias docs, with the bitmaps as alias bits."""
    bits = keep_bitmaps(docs.select("doc_id", "text"), **how).alias("bits")
    same = F.col("docs.doc_id").eqNullSafe(F.col("bits.doc_id")) & (F.xxhash64("docs.text") == F.col("bits.body"))
    return docs.alias("docs").join(bits, same, "left")


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines of ``text`` in ``keep_runs``, joined by line feeds; the whole text where there are none."""
    lines = F.split(text, "\n")
    some = F.array_join(F.flatten(F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")
    return F.when(keep_runs.isNull(), text).otherwise(some)


def drop_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every text cut to the lines that stay; a text without lines left is empty.

    Keywords are those of ``keep_bitmaps``. All columns stay, of any name;
    repeated rows count as documents and lose the same lines; a null text stays
    null; no rows give no rows.
    """
    both = _beside(docs, **how)
    text = kept_text(F.col("docs.text"), F.col("bits.keep_runs")).alias("text")
    return both.select(*(text if c == "text" else F.col(f"docs.`{c}`") for c in docs.columns))


def line_digest(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document; keywords are those of ``keep_bitmaps``.

    Null and empty texts have one empty line, which has no key and stays. Rows
    are documents: those that repeat each count and are each returned, and a
    null doc_id is one more id. A long text is split within its row. No
    documents give no rows. Only doc_id and text are read.
    """
    both = _beside(docs.select("doc_id", "text"), **how)
    whole = F.coalesce("docs.text", F.lit(""))
    n_lines = (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long")
    dropped = F.coalesce("bits.n_dropped", F.lit(0).cast("long"))
    return both.select("docs.doc_id", n_lines.alias("n_lines"), dropped.alias("n_dropped"), F.sha2(kept_text(whole, F.col("bits.keep_runs")), 256).alias("kept_sha256"))
