"""Evidence atoms, frozen worlds, layered lookup, digests and leakage-free splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceloom.operators.graph import connected_components


def atoms(docs: DataFrame) -> DataFrame:
    """Content hashes that several records share, with their least and greatest record."""
    return docs.groupBy(F.sha2("text", 256).alias("atom")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("n > 1")


def world(calls: DataFrame) -> DataFrame:
    """One result per key: of several results of a part and supplier the one with the least hash."""
    result = F.concat_ws("|", "l_returnflag", "l_linestatus")
    c = calls.select(F.sha2(F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")), 256).alias("key_sha256"), result.alias("result"))
    return c.groupBy("key_sha256").agg(F.min_by("result", F.sha2("result", 256)).alias("result"), F.countDistinct("result").alias("n_results"))


def conflicts(calls: DataFrame) -> DataFrame:
    """How often each result occurs for keys that have several."""
    per = calls.groupBy("l_partkey", "l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    split = per.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("variants"), F.sum("n").alias("n"), F.expr("array_join(transform(array_sort(collect_list(struct(l_returnflag, n))), x -> concat(x.l_returnflag, ':', x.n)), ',')").alias("occurrences"))
    return split.where("variants > 1")


def layered_lookup(orders: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    """Sealed answer (a building customer), then cached (any other), then the fallback; with the kind of each."""
    sealed = customers.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k1"), F.col("c_name").alias("a1"))
    cached = customers.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("k2"), F.col("c_name").alias("a2"))
    o = orders.join(sealed, orders["o_custkey"] == F.col("k1"), "left").join(cached, orders["o_custkey"] == F.col("k2"), "left")
    kind = F.when(F.col("k1").isNotNull(), "sealed").when(F.col("k2").isNotNull(), "cached").otherwise("fallback")
    return o.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.min(F.coalesce("a1", "a2", F.lit("none"))).alias("least_answer"))


def manifest(orders: DataFrame) -> DataFrame:
    """Counts by status, by priority, and in all."""
    orders.createOrReplaceTempView("__manifest")
    return orders.sparkSession.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM __manifest GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority))")


def digest(nations: DataFrame) -> DataFrame:
    """Per region, the hash of its sorted ``name NUL hash LF`` lines."""
    line = nations.select("n_regionkey", F.struct("n_name", F.sha2("n_name", 256).alias("h")).alias("x"))
    text = F.expr("array_join(transform(array_sort(collect_list(x)), x -> concat(x.n_name, '|', x.h)), ';')")
    return line.groupBy("n_regionkey").agg(F.sha2(text, 256).alias("digest"))


def evidence_groups(docs: DataFrame) -> DataFrame:
    """Records that share source and length are one group, transitively with shared texts."""
    keyed = docs.select("doc_id", F.explode(F.array(F.sha2("text", 256), F.concat_ws(":", "source", "n_chars"))).alias("k"))
    edges = keyed.join(keyed.groupBy("k").agg(F.min("doc_id").alias("root")), "k").where("doc_id <> root")
    found = connected_components(edges, "doc_id", "root")
    all_docs = docs.select("doc_id").join(found, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("group_id"))
    return all_docs.groupBy("group_id").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))


def grouped_split(docs: DataFrame, percent: int = 10) -> DataFrame:
    """Whole groups of equal texts go to one side by a hash of the text."""
    side = F.when(F.expr(f"conv(substr(sha2(text, 256), 1, 4), 16, 10) % 100 < {percent}"), "held_out").otherwise("train")
    return docs.groupBy(side.alias("side"), "lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("n_texts"))


def leakage(docs: DataFrame) -> DataFrame:
    """Texts on both sides of a split by parity of doc_id: what a split without groups would leak."""
    even, odd = (docs.where(f"doc_id % 2 = {r}").select(F.sha2("text", 256).alias("atom")) for r in (0, 1))
    return even.intersect(odd)


def coverage(events: DataFrame) -> DataFrame:
    """Expected pairs of user bucket and type that were never observed."""
    seen = events.select((F.col("user_id") % 50).alias("bucket"), "event_type", F.hour("ts").alias("hour")).distinct()
    want = seen.select("bucket").distinct().join(seen.select("event_type").distinct()).join(F.broadcast(events.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))))
    return want.join(seen, ["bucket", "event_type", "hour"], "left_anti")
