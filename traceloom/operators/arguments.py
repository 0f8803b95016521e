"""Arguments of calls: typed projection, rules, bindings, renaming, templates, seeds and fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import small_side


def typed(events: DataFrame) -> DataFrame:
    """The declared keys of the JSON arguments: a whole number ``k``, which is required, and an optional note, empty by default."""
    k = F.expr("try_cast(get_json_object(props, '$.k') AS int)")
    return events.select("event_id", k.alias("k"), F.coalesce(F.get_json_object("props", "$.note"), F.lit("")).alias("note"), k.isNotNull().alias("ok"))


def schema_rules(events: DataFrame, keys: tuple[str, ...] = ("k",), low: int = 1, high: int = 30) -> DataFrame:
    """Calls that keep each rule: an object, no undeclared key, a whole number within its range."""
    k = F.expr("try_cast(get_json_object(props, '$.k') AS int)")
    declared = F.array(*map(F.lit, keys))
    rules = {"object": F.json_object_keys("props").isNotNull(), "declared": F.size(F.array_except(F.json_object_keys("props"), declared)) == 0, "in_range": k.between(low, high)}
    wide = events.select(*(F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()))
    pairs = ", ".join(f"'{n}', {n}" for n in rules)
    return wide.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, ok)")).groupBy("rule").agg(F.count_if("ok").alias("n_pass"), F.count("*").alias("n"))


def latest_binding(events: DataFrame, source: str = "view", target: str = "purchase") -> DataFrame:
    """Each target call with the value of the user's latest earlier source call; without one it is unbound."""
    earlier = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    bound = F.last(F.when(F.col("event_type") == source, F.col("value")), ignorenulls=True).over(earlier)
    return events.withColumn("bound", bound).where(F.col("event_type") == target).select("event_id", "bound", F.when(F.col("bound").isNull(), "unbound").otherwise("ok").alias("status"))


def slot_collisions(events: DataFrame, names: dict[str, str]) -> DataFrame:
    """Slots that take different values on one user-day after their names are mapped; unmapped names stay."""
    mapped = reduce(lambda rest, n: F.when(F.col("event_type") == n, names[n]).otherwise(rest), names, F.col("event_type"))
    slots = events.groupBy("user_id", F.to_date("ts").alias("day"), mapped.alias("slot")).agg(F.countDistinct("value").alias("n_values"))
    return slots.where("n_values > 1").groupBy("slot").agg(F.count("*").alias("n"), F.max("n_values").alias("most"))


def render(template: str, **fields: Column) -> Column:
    """``template`` with each {name} replaced by its column; a null counts as empty."""
    return reduce(lambda t, n: F.replace(t, F.lit("{" + n + "}"), F.coalesce(fields[n].cast("string"), F.lit(""))), fields, F.lit(template))


def customer_cards(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """A rendered line for each customer; nations are a table of fixed size."""
    both = customers.join(small_side(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return both.select("c_custkey", render("{name} of {nation}: {segment}", name=F.col("c_name"), nation=F.col("n_name"), segment=F.col("c_mktsegment")).alias("card"))


def seeded_values(parts: DataFrame, salt: str = "f", n: int = 97) -> DataFrame:
    """A reproducible stand-in value for each key, from the first 32 bits of the hash of salt and key."""
    h = F.sha2(F.concat_ws("/", F.lit(salt), F.col("p_partkey").cast("string")), 256)
    return parts.select("p_partkey", (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % n).alias("value"))


def attempt_seeds(parts: DataFrame, seed: int = 7, attempts: int = 4) -> DataFrame:
    """seed + 10000 * position + 100 * attempt for every attempt at every position."""
    a = parts.select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))).alias("attempt"))
    return a.select("p_partkey", "attempt", (F.lit(seed) + F.col("p_partkey") * 10_000 + F.col("attempt") * 100).cast("long").alias("seed"))


def fingerprints(parts: DataFrame) -> DataFrame:
    """Parts with one identity (brand, size and type in fixed key order), by the hash of that identity."""
    identity = F.concat_ws("|", "p_brand", F.col("p_size").cast("string"), "p_type")
    return parts.groupBy(F.sha2(identity, 256).alias("fingerprint")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))
