"""Field-by-field audit of two versions of a table, to any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceloom.functions.leaves import json_leaves
from traceloom.session import cut


def row_leaves(columns: list[str], json_columns: list[str]) -> Column:
    """Leaves of a row's columns, as ``$.column`` and on; texts in ``json_columns`` are read as JSON, or, where they are none, kept whole."""
    plain = [c for c in columns if c not in json_columns]
    parts = [json_leaves(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}))] if plain else []
    for c in json_columns:
        whole = F.array(F.struct(F.lit("$").alias("path"), F.when(F.col(c).isNull(), "null").otherwise("no json").alias("type"), F.col(c).alias("value")))
        parts.append(F.transform(F.coalesce(json_leaves(c), whole), lambda x: F.struct(F.concat(F.lit(f"$.{c}"), F.substr(x["path"], F.lit(2))).alias("path"), x["type"].alias("type"), x["value"].alias("value"))))
    return F.concat(*parts)


def audit(left: DataFrame, right: DataFrame, key: list[str], json_columns: tuple[str, ...] = ()) -> DataFrame:
    """(key, path, problem, left, right), a row for everything in which two tables that share a key differ.

    Problems of a record, at path ``$``: ``repeated left``, ``repeated right``,
    ``missing left``, ``missing right``; a repeated record is not compared
    further. Problems of a leaf: ``only left``, ``only right``, ``type``,
    ``value``. Equal tables give no rows. Keys are compared null-safe.

    Both sides are shuffled once by key; only records that differ are written
    and taken apart, and their leaves meet by key and path.
    """
    columns = sorted((set(left.columns) | set(right.columns)) - set(key))

    def side(df: DataFrame, name: str) -> DataFrame:
        own = [c for c in columns if c in df.columns]
        body = F.struct(*own) if own else F.struct(F.lit(0).alias("none"))
        one = df.groupBy(*key).agg(F.count("*").alias("n"), F.first(body).alias("row"))
        return one.select(*(F.col(k).alias(f"{name}_{k}") for k in key), F.col("n").alias(f"{name}_n"), F.col("row").alias(f"{name}_row"))

    a, b = side(left, "l"), side(right, "r")
    same_key = [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in key]
    both = a.join(b, same_key, "full")
    named = [F.when(F.col("l_n").isNotNull(), F.col(f"l_{k}")).otherwise(F.col(f"r_{k}")).alias(k) for k in key]
    both = both.select(*named, "l_n", "l_row", "r_n", "r_row")
    if [f for f in left.schema if f.name in columns] == [f for f in right.schema if f.name in columns]:
        both = both.where(~(F.col("l_n").eqNullSafe(1) & F.col("r_n").eqNullSafe(1) & F.col("l_row").eqNullSafe(F.col("r_row"))))  # equal rows need not be taken apart
    both = cut(both)
    none = F.lit(None).cast("string")
    problem = F.when(F.col("l_n").isNull(), "missing left").when(F.col("r_n").isNull(), "missing right").when(F.col("l_n") > 1, "repeated left").when(F.col("r_n") > 1, "repeated right")
    records = both.select(*key, F.lit("$").alias("path"), problem.alias("problem"), none.alias("left"), none.alias("right")).where("problem IS NOT NULL")
    met = both.where("l_n = 1 AND r_n = 1")

    def taken(row: str, df: DataFrame) -> DataFrame:
        own = [c for c in columns if c in df.columns]
        apart = met.select(*key, f"{row}.*") if own else met.select(*key)
        parts = row_leaves(own, [c for c in json_columns if c in own]) if own else F.expr("cast(array() AS array<struct<path:string,type:string,value:string>>)")
        # Of an inner explode Spark derives a filter that takes records apart again.
        return apart.select(*key, F.explode_outer(parts).alias("x")).where("x IS NOT NULL").select(*key, "x.*")

    x, y = taken("l_row", left).alias("x"), taken("r_row", right).alias("y")
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in key] + [F.col("x.path") == F.col("y.path")]
    leaf = x.join(y, on, "full")
    why = F.when(F.col("y.path").isNull(), "only left").when(F.col("x.path").isNull(), "only right").when(F.col("x.type") != F.col("y.type"), "type").when(~F.col("x.value").eqNullSafe(F.col("y.value")), "value")
    pick = [F.when(F.col("x.path").isNotNull(), F.col(f"x.{k}")).otherwise(F.col(f"y.{k}")).alias(k) for k in key]
    leaf = leaf.select(*pick, F.coalesce("x.path", "y.path").alias("path"), why.alias("problem"), F.col("x.value").alias("left"), F.col("y.value").alias("right")).where("problem IS NOT NULL")
    return records.unionByName(leaf)


def first_difference(found: DataFrame, key: list[str]) -> DataFrame:
    """(key, path, problem): of each record that differs the first path in order, and how many there are."""
    return found.groupBy(*key).agg(F.min_by("problem", F.struct("path", "problem")).alias("problem"), F.min("path").alias("path"), F.count("*").alias("n"))
