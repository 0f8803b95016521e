"""Line files whose errors name file and line, at any split size and in any store that Spark reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def _located(spark: SparkSession, path: str) -> DataFrame:
    """(text, file, block, at): ``at`` counts on by one from line to line of a block of a file."""
    where = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return spark.read.text(path).select(F.col("value").alias("text"), *where, F.monotonically_increasing_id().alias("at"))


def numbered(spark: SparkSession, path: str, which: Column | None = None) -> DataFrame:
    """(file, line, text) of the lines, counted from 1 in their file, or of those with ``which``, a condition on ``text``.

    A first pass counts the lines of each block of a file, that is, of what one
    task reads; a block's lines are set off by those of the blocks before it.
    No task holds a file and no line is shuffled.
    """
    lines = _located(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", (before - F.col("first") + 1).alias("off"))
    some = lines if which is None else lines.where(which)
    return some.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("off")).alias("line"), "text")


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of JSON lines. Blank lines are skipped; a line that is no object of the schema is an error that names the first such file and line.

    Lines are checked when this is called, in one pass; only if one is bad are
    lines counted. An empty file gives no records; keys that the schema has not
    are left out.
    """
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    # A column of this name gets the lines that do not parse.
    bad = "__bad_line"
    read = F.from_json("text", kind.add(bad, StringType()) if bad not in kind.names else kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    solid = F.trim("text") != ""
    wrong = solid & (read[bad].isNotNull() | ~F.coalesce(F.ltrim("text").startswith("{"), F.lit(False)))
    lines = _located(spark, path)
    if not lines.where(wrong).isEmpty():
        first = numbered(spark, path, wrong).orderBy("file", "line").first()
        raise ValueError(f"{first.file}, line {first.line}: no record of the schema: {first.text[:200]}")
    names = [n for n in kind.names if n != bad]
    return lines.where(solid).select(read.alias("r")).select(*(F.col(f"r.{n}") for n in names))
