"""Segments, rounds, prefixes and loss spans of conversations (conv_id, turn, role, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_turn():
    return Window.partitionBy("conv_id").orderBy("turn")


def so_far():
    return by_turn().rowsBetween(Window.unboundedPreceding, 0)


def with_segments(messages: DataFrame) -> DataFrame:
    """Adds ``seg``: a new segment begins at each user turn; what precedes the first is segment 0."""
    return messages.withColumn("seg", F.sum((F.col("role") == "user").cast("long")).over(so_far()))


def segments(messages: DataFrame) -> DataFrame:
    """One row per segment, without what precedes the first user turn."""
    own = with_segments(messages).where("seg >= 1").groupBy("conv_id", "seg")
    return own.agg(F.count("*").alias("n_messages"), F.count_if(F.col("role") == "assistant").alias("n_assistant"), F.sum(F.length("text")).alias("n_chars"))


def segment_percentiles(messages: DataFrame) -> DataFrame:
    """Per number of segments: conversations and nearest-rank percentiles of their length."""
    per = segments(messages).groupBy("conv_id").agg(F.count("*").alias("n_segments"), F.sum("n_chars").alias("n_chars"))
    rank = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY n_chars)").cast("long")
    return per.groupBy("n_segments").agg(F.count("*").alias("n_conversations"), rank(0.5).alias("p50"), rank(0.95).alias("p95"))


def rounds(messages: DataFrame) -> DataFrame:
    """Gaps and islands: consecutive messages of one role are a round."""
    new = (F.lag("role").over(by_turn()) != F.col("role")) | F.lag("role").over(by_turn()).isNull()
    tagged = messages.withColumn("round", F.sum(F.when(new, 1).otherwise(0)).over(so_far()))
    return tagged.groupBy("conv_id", F.col("round").cast("long").alias("round")).agg(F.min("role").alias("role"), F.count("*").alias("n_messages"), F.min("turn").alias("first_turn"))


def prefixes(messages: DataFrame, final_copies: int = 3) -> DataFrame:
    """A training row for every assistant turn with all that precedes it; the last of several is repeated.

    A conversation with at most one assistant turn is one row and not repeated.
    """
    whole = Window.partitionBy("conv_id")
    sized = messages.withColumn("n_prior", F.count("*").over(so_far())).withColumn("chars", F.sum(F.length("text")).over(so_far()))
    sized = sized.withColumn("n_assistant", F.count_if(F.col("role") == "assistant").over(whole))
    ends = sized.where("role = 'assistant'").withColumn("nth", F.row_number().over(by_turn()).cast("long"))
    copies = F.when((F.col("nth") == F.col("n_assistant")) & (F.col("n_assistant") > 1), F.lit(final_copies)).otherwise(1)
    return ends.select("conv_id", "nth", "n_prior", "chars", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long"))).alias("copy"))


def training_prefixes(messages: DataFrame, final_copies: int = 3) -> DataFrame:
    """(conv_id, nth, copy, conversation): what a model is trained on, with all messages (role, text) up to its target.

    A conversation without a ``tool`` message is one row, whole, with nth 0.
    Another one gives a row for every assistant message, the last of them
    ``final_copies`` times; without any it gives none. Null texts stay null. A
    conversation is held in a row, as its rows are.
    """
    whole = messages.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))).alias("m"))
    ends = F.filter(F.transform("m", lambda m, i: F.when(m["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    found = whole.withColumn("ends", F.when(F.exists("m", lambda m: F.coalesce(m["role"] == "tool", F.lit(False))), ends).otherwise(F.array(F.lit(None).cast("int"))))
    each = found.select("conv_id", "m", F.size("ends").alias("of"), F.posexplode("ends").alias("at", "end"))
    copies = F.when(F.col("end").isNotNull() & (F.col("at") + 1 == F.col("of")), final_copies).otherwise(1)
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return each.select("conv_id", F.when(F.col("end").isNull(), 0).otherwise(F.col("at") + 1).alias("nth"), "copy", F.slice("m", F.lit(1), F.coalesce("end", F.size("m"))).alias("conversation"))


def longest_prefix(messages: DataFrame) -> DataFrame:
    """Of each conversation's prefixes the longest, the first among equals."""
    best = Window.partitionBy("conv_id").orderBy(F.desc("n_prior"), "copy")
    return prefixes(messages).withColumn("r", F.row_number().over(best)).where("r = 1").select("conv_id", "n_prior", "chars")


def last_n(messages: DataFrame, n: int = 4) -> DataFrame:
    """History cap: the last ``n`` messages, numbered anew."""
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    kept = messages.withColumn("r", F.row_number().over(back)).where(F.col("r") <= n)
    return kept.select("conv_id", "turn", "role", (F.count("*").over(Window.partitionBy("conv_id")) - F.col("r")).alias("position"))


def assistant_spans(messages: DataFrame) -> DataFrame:
    """Character span of every assistant message in the rendered conversation, by differences of prefix lengths."""
    line = F.length("role") + F.length("text") + 3
    run = messages.withColumn("upto", F.sum(line).over(so_far())).withColumn("last", F.max(F.when(F.col("role") == "assistant", F.col("turn"))).over(Window.partitionBy("conv_id")))
    spans = run.where("role = 'assistant'")
    return spans.select("conv_id", "turn", (F.col("upto") - F.length("text") - 1).alias("start"), (F.col("upto") - 1).alias("stop"), (F.col("turn") == F.col("last")).alias("is_last"))


def order_audit(messages: DataFrame) -> DataFrame:
    """PASS or FAIL per rule: contiguous ordinals, a user first, no system turn later, alternation."""
    numbered = messages.withColumn("r", F.row_number().over(by_turn()) - 1).withColumn("before", F.lag("role").over(by_turn()))
    per = numbered.groupBy("conv_id").agg(
        F.bool_and(F.col("r") == F.col("turn")).alias("contiguous"),
        F.bool_and((F.col("role") != "system") | (F.col("r") == 0)).alias("system_first"),
        F.bool_and(F.col("before").isNull() | (F.col("before") != F.col("role"))).alias("alternating"),
    )
    long = per.select("conv_id", F.expr("stack(3, 'contiguous', contiguous, 'system_first', system_first, 'alternating', alternating) AS (rule, ok)"))
    return long.groupBy("rule").agg(F.count_if("ok").alias("n_pass"), F.count_if(~F.col("ok")).alias("n_fail"), F.min(F.when(~F.col("ok"), F.col("conv_id"))).alias("first_fail"))
