"""Exact ranks and running sums of groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceloom.session import cut


def running(rows: DataFrame, group: list[str], order: list[str], weight: str) -> DataFrame:
    """Adds ``upto``, the sum of ``weight`` in a group up to and with this row, and ``total``, that of the group.

    Rows are dealt by ranges of (group, order), so a large group is split; sums
    within a range are set off by those of the ranges before it. The ranges are
    written once, since another sample of them would number rows otherwise.
    Groups and orders are not null; rows equal in both have no fixed order.
    """
    dealt = cut(rows.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id()))
    of = Window.partitionBy(*group)
    sums = dealt.groupBy("range", *group).agg(F.sum(weight).alias("n"))
    before = F.coalesce(F.sum("n").over(of.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("range", *group, before.alias("before"), F.sum("n").over(of).alias("total"))
    own = Window.partitionBy("range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumn("own", F.sum(weight).over(own))
    return local.join(sums, ["range", *group]).withColumn("upto", F.col("own") + F.col("before")).drop("range", "own", "before")


def hash_ranks(rows: DataFrame, group: str, key: str, digits: int = 3) -> DataFrame:
    """Adds ``rank``, from 1, by a column of hex hashes in a group, and ``n``, the group's size.

    The first digits of a hash cut a group into even ranges, so no range needs
    to be sampled or written: ranks are counted in a range and set off by the
    sizes of those before it.
    """
    cells = rows.withColumn("cell", F.left(key, F.lit(digits)))
    of = Window.partitionBy(group)
    sizes = cells.groupBy(group, "cell").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(of.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(group, "cell", before.alias("before"), F.sum("size").over(of).alias("n"))
    own = F.row_number().over(Window.partitionBy(group, "cell").orderBy(key))
    local = cells.withColumn("own", own)
    return local.join(sizes, [group, "cell"]).withColumn("rank", F.col("own") + F.col("before")).drop("cell", "own", "before")
