"""Hash-ordered permutations, quotas, anchors and batch schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.operators.ranks import hash_ranks, running


def permutation(events: DataFrame, salt: str = "s", buckets: int = 64) -> DataFrame:
    """Rank within a bucket of a user's events by the hash of salt and id."""
    key = F.sha2(F.concat_ws("/", F.lit(salt), F.col("event_id").cast("string")), 256)
    e = events.select("event_id", (F.col("user_id") % buckets).alias("bucket"), key.alias("key"))
    return hash_ranks(e, "bucket", "key").select("event_id", "bucket", F.col("rank").cast("int").alias("rank"))


def first_n(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return rows.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("r") <= n).drop("r")


def quotas(parts: DataFrame, total: int = 1000) -> DataFrame:
    """``total`` shared among brands in proportion, the remainder by largest fraction, ties by name."""
    c = parts.groupBy("p_brand").agg(F.count("*").alias("n"))
    all_n = F.sum("n").over(Window.partitionBy(F.lit(1)))
    c = c.select("p_brand", "n", F.expr(f"n * {total}").alias("x"), all_n.alias("all_n"))
    c = c.select("p_brand", F.expr("x div all_n").alias("base"), F.expr("x % all_n").alias("rest"))
    spare = F.lit(total) - F.sum("base").over(Window.partitionBy(F.lit(1)))
    rank = F.row_number().over(Window.orderBy(F.desc("rest"), "p_brand"))
    return c.select("p_brand", (F.col("base") + (rank <= spare).cast("long")).alias("quota"))


def anchors(docs: DataFrame, labels: DataFrame, per: int = 5) -> DataFrame:
    """Of each language, ``per`` labelled records of each class in hash order."""
    j = docs.select("doc_id", "lang").join(labels, "doc_id")
    rank = F.row_number().over(Window.partitionBy("lang", "toxic").orderBy(F.sha2(F.col("doc_id").cast("string"), 256)))
    return j.withColumn("rank", rank).where(F.col("rank") <= per).select("lang", "toxic", "doc_id", "rank")


def schedule(parts: DataFrame, size: int = 32) -> DataFrame:
    """Batches of ``size`` of each brand, in hash order; the last is filled from its beginning."""
    r = hash_ranks(parts.select("p_brand", "p_partkey", F.sha2(F.col("p_partkey").cast("string"), 256).alias("key")), "p_brand", "key").withColumn("at", F.col("rank") - 1)
    full = r.withColumn("padding", (size - F.col("n") % size) % size)
    again = full.where("at < padding").select("p_brand", "p_partkey", (F.col("at") + F.col("n")).alias("at"))
    return full.select("p_brand", "p_partkey", "at").union(again).select("p_brand", "p_partkey", F.expr(f"cast(at div {size} AS bigint)").alias("batch"), (F.col("at") % size).cast("long").alias("slot"))


def stratified(rows: DataFrame, ident: str, stratum: str, types: dict[str, dict[str, int]], counts: dict[str, int], salt: str = "") -> DataFrame:
    """(batch, slot, stratum, ident, occurrence): batches of mixed strata, each of a type that fixes how many rows of a stratum it has.

    ``counts`` tells how many batches there are of a type; these come in hash
    order. A stratum's rows fill its places from the first batch on, also in
    hash order, each once; places left at the end take its first rows a second
    time. Batches are shuffled within. Idents are unique and not null. An error:
    more rows than places, an unknown stratum, or so few rows that one would
    come twice in a batch or three times at all.

    Places and rows meet by their number in the stratum, an equality, so
    neither strata nor batches are gathered.
    """
    spark = rows.sparkSession
    tags = spark.createDataFrame([(t, n) for t, n in sorted(counts.items()) if n], "type string, n long").select("type", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k"))
    tags = tags.withColumn("key", F.sha2(F.concat_ws("/", F.lit(f"{salt}batch"), "type", F.col("k").cast("string")), 256)).withColumn("one", F.lit(1))
    batches = hash_ranks(tags, "one", "key").select("type", (F.col("rank") - 1).alias("batch"))
    quota = spark.createDataFrame([(t, s, q) for t, of in sorted(types.items()) for s, q in sorted(of.items())], "type string, stratum string, quota long")
    wide = batches.join(F.broadcast(quota), "type").where("quota > 0")  # types times strata, a parameter
    places = running(wide, ["stratum"], ["batch"], "quota").select("batch", "stratum", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("place"))

    key = F.sha2(F.concat_ws("/", F.lit(f"{salt}row"), F.col(ident).cast("string")), 256)
    pool = hash_ranks(rows.select(F.col(ident).alias("ident"), F.col(stratum).alias("stratum"), key.alias("key")), "stratum", "key").select("ident", "stratum", (F.col("rank") - 1).alias("at"), "n")
    sizes, room = {r.stratum: r.n for r in rows.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n")).limit(quota.count() + 1).collect()}, {}
    for t, of in types.items():
        for s, q in of.items():
            room[s] = room.get(s, 0) + q * counts.get(t, 0)
    for s, n in sizes.items():
        spare, most = room.get(s, 0) - n, max(of.get(s, 0) for of in types.values())
        if spare < 0 or spare > max(0, n - most):
            raise ValueError(f"{n} rows of {s} for {room.get(s, 0)} places")
    if missing := [s for s, q in room.items() if q and s not in sizes]:
        raise ValueError(f"no rows of {missing}")
    twice = pool.withColumn("place", F.explode(F.array(F.col("at"), F.col("at") + F.col("n")))).withColumn("occurrence", (F.col("place") >= F.col("n")).cast("int") + 1)
    put = places.join(twice, ["stratum", "place"])
    within = Window.partitionBy("batch").orderBy(F.sha2(F.concat_ws("/", F.lit(f"{salt}slot"), F.col("batch").cast("string"), F.col("ident").cast("string")), 256))
    return put.select("batch", (F.row_number().over(within) - 1).alias("slot"), "stratum", F.col("ident").alias(ident), "occurrence")


def stratified_problems(schedule: DataFrame, rows: DataFrame, ident: str, stratum: str, types: dict[str, dict[str, int]], counts: dict[str, int]) -> DataFrame:
    """(problem, n) of a schedule of ``stratified``: rows that never come or come too often, batches with a row twice or of no such type. No rows: none."""
    spark, seen = rows.sparkSession, schedule.groupBy(ident).agg(F.count("*").alias("n"))
    often = rows.join(seen, ident, "left").select(F.when(F.col("n").isNull(), "never comes").when(F.col("n") > 2, "comes too often").alias("problem"))
    inside = schedule.groupBy("batch", ident).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("twice in a batch").alias("problem"))
    made = schedule.groupBy("batch", "stratum").agg(F.count("*").alias("n")).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("stratum", "n"))).alias("has"))
    kinds = [(t, sorted((s, q) for s, q in of.items() if q), counts.get(t, 0)) for t, of in types.items()]
    kinds = spark.createDataFrame(kinds, "type string, has array<struct<stratum: string, n: long>>, want long")
    held = made.join(F.broadcast(kinds), "has", "left").groupBy("type").agg(F.count("*").alias("n"), F.first("want").alias("want"))
    wrong = held.where("type IS NULL OR n <> want").select(F.when(F.col("type").isNull(), "batch of no type").otherwise("batches of a type").alias("problem"))
    return often.where("problem IS NOT NULL").union(inside).union(wrong).groupBy("problem").agg(F.count("*").alias("n"))
