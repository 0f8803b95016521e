"""Benchmark decontamination: a hash set of the benchmark's n-grams, probed with every token window.

DataFrame functions only. A window travels as two independent 64-bit hashes of
its words' hashes, of which the first is probed and the second verifies. The benchmark's windows are broadcast while they
number at most ``max_broadcast``; a larger benchmark is joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.session import cut, small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: str) -> Column:
    """Words of a text column: A-Z lower-cased, split at every other ASCII character but digits."""
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), GAPS), "")


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(size, key, proof, item_id): every window of ``size`` words; a shorter item is one window."""
    w = benchmark.select("item_id", normal_words("text").alias("w")).where("size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(size)))
    grams = w.select("item_id", "size", F.explode(F.expr("transform(sequence(1, size(w) - size + 1), i -> slice(w, i, size))")).alias("gram"))
    grams = grams.select("size", "item_id", F.transform("gram", lambda x: F.xxhash64(x)).alias("gram"))
    return grams.select("size", F.xxhash64("gram").alias("key"), F.xxhash64(F.lit(1), "gram").alias("proof"), "item_id").distinct()


def _hits(docs: DataFrame, benchmark: DataFrame, size: int, max_broadcast: int) -> DataFrame | None:
    """(doc_id, body, n_hit, n_items, items_sha256) of the texts that hold a window; ``body`` is a hash of the text.

    Words are hashed once; a window's key is the hash of its words' hashes. All
    window lengths of the benchmark are probed in one pass, and the proof is
    computed where a key is found.
    """
    grams = cut(benchmark_windows(benchmark, size))
    sizes = [r[0] for r in grams.select("size").distinct().orderBy("size").collect()]  # at most `size` values
    if not sizes:
        return None
    one = docs.select("doc_id", F.xxhash64("text").alias("body"), F.transform(normal_words("text"), lambda x: F.xxhash64(x)).alias("h"))
    words = lambda n, i: ", ".join(f"get(h, {i} + {k})" for k in range(n))  # noqa: E731  no slices: each would copy its whole array
    probes = [F.struct(F.lit(n).alias("n"), F.expr(f"transform(h, (x, i) -> xxhash64({words(n, 'i')}))").alias("keys")) for n in sizes]
    keys = one.withColumn("p", F.explode(F.array(*probes))).select("doc_id", "body", "h", "p.n", F.posexplode("p.keys").alias("at", "key"))
    keys = keys.where(F.col("at") + F.col("n") <= F.size("h"))
    proof = F.lit(None).cast("long")
    for n in sizes:
        proof = F.when(F.col("n") == n, F.expr(f"xxhash64(1, {words(n, 'at')})")).otherwise(proof)
    few = grams.withColumnRenamed("proof", "wanted")
    if few.limit(max_broadcast + 1).count() <= max_broadcast:
        few = F.broadcast(few)
    else:  # joined by shuffle: no row may carry its document's words
        keys = keys.select("doc_id", "body", "at", "n", "key", proof.alias("proof"))
        proof = F.col("proof")
    hits = keys.join(few, "key").where((F.col("n") == F.col("size")) & (proof == F.col("wanted"))).select("doc_id", "body", "at", "n", "item_id")
    found = hits.groupBy("doc_id", "body").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("at"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    covered = F.expr("aggregate(at, named_struct('end', 0, 'n', 0L), (a, x) -> named_struct('end', greatest(a.end, x.at + x.n), 'n', a.n + greatest(0, x.at + x.n - greatest(a.end, x.at))), a -> a.n)")
    return cut(found.select("doc_id", "body", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, max_broadcast: int = 300_000) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A word is hit if any occurrence of a benchmark window covers it. Null and
    empty texts have no words and are clean; items without words have no
    window; an empty benchmark hits nothing. Rows that repeat a doc_id are each
    judged by their own text and each returned. A text is split whole, however
    long, within one row. No documents give no rows. Only doc_id, text and
    item_id are read.
    """
    read = docs.select("doc_id", "text")
    counts = read.select("doc_id", F.xxhash64("text").alias("body"), F.size(normal_words("text")).cast("long").alias("n_words"))
    found, nothing = _hits(read, benchmark, size, max_broadcast), F.sha2(F.lit(""), 256)
    if found is None:
        return counts.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), nothing.alias("items_sha256"), F.lit(False).alias("contaminated"))
    found = small_side(found.select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "n_hit", "n_items", "items_sha256"))
    back = counts.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of")), "left")
    return back.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", nothing).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window; all columns stay.

    Rows are judged by doc_id and text together, null doc_ids included, so a
    clean row never goes for another's sake. Null and empty texts stay, repeated
    rows go or stay together, no rows give no rows, and an empty benchmark drops
    nothing. Columns may have any name: both sides are named by alias.
    """
    found = _hits(docs.select("doc_id", "text"), benchmark, size, 300_000)
    if found is None:
        return docs
    bad = small_side(found.select("doc_id", "body")).alias("bad")
    same = F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id")) & (F.xxhash64("docs.text") == F.col("bad.body"))
    return docs.alias("docs").join(bad, same, "left_anti")
