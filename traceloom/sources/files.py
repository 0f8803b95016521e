"""Readers and sinks of the data jobs: JSON with fallback, numbered and sealed files, keyed and append-only tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str, form: str = "jsonl", schema: str | None = None, strict: bool = True) -> DataFrame:
    """Records of ``json`` (arrays), ``jsonl`` or ``parquet`` files. Strict reading fails on a bad line, else it is left out."""
    if form == "parquet":
        return spark.read.parquet(path)
    if form not in ("json", "jsonl"):
        raise ValueError(f"no such form: {form}")
    reader = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED").option("multiLine", form == "json")
    return (reader.schema(schema) if schema else reader).json(path)


def read_conversations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of one JSON array, or, where the text begins otherwise or the array holds none, of lines, without bad ones. No record at all is an error.

    The first text that is not blank decides on the form, so all files under the path must share it.
    """
    head = spark.read.text(path).where("trim(value) <> ''").select(F.left(F.trim("value"), F.lit(1))).limit(1).collect()
    rows = read_records(spark, path, "json", schema, strict=False) if head and head[0][0] == "[" else None
    if rows is None or rows.isEmpty():
        rows = read_records(spark, path, "jsonl", schema, strict=False)
    if rows.isEmpty():
        raise ValueError(f"no records in {path}")
    return rows


def read_numbered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Files named by number, with the number as ``file_id``; others are left out."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9]+)\.json$", 1)
    return spark.read.schema(schema).option("multiLine", True).json(folder).withColumn("file_id", stem.try_cast("int")).where("file_id IS NOT NULL")


def sealed(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(name, status) of a folder's files against a manifest (name, sha256): ok, changed, missing or extra."""
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("found"))
    both = files.join(manifest, "name", "full")
    status = F.when(F.col("sha256").isNull(), "extra").when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("sha256"), "ok").otherwise("changed")
    return both.select("name", status.alias("status"))


def append_new(df: DataFrame, path: str, key: str) -> int:
    """Appends the rows whose key is not in the table; returns the number added.

    Equal rows of one append are written once. A key that comes with two values,
    in the append or against the table, is an error, and then nothing is written.
    """
    spark, rest = df.sparkSession, [c for c in df.columns if c != key]
    df = df.distinct()
    clash = df.groupBy(key).count().where("count > 1")
    if not clash.isEmpty():
        raise ValueError(f"{key} comes with two values in one append")
    if not _there(spark, path):
        df.write.parquet(path)
        return spark.read.parquet(path).count()
    old = spark.read.parquet(path)
    differs = df.join(old.select(key, *(F.col(c).alias(f"__{c}") for c in rest)), key).where(~F.forall(F.array(*(F.col(c).eqNullSafe(F.col(f"__{c}")) for c in rest)), lambda x: x))
    if not differs.isEmpty():
        raise ValueError(f"{key} is there with other values")
    new = df.join(old.select(key), key, "left_anti").cache()
    n = new.count()
    new.write.mode("append").parquet(path)
    new.unpersist()
    return n


def write_checked(df: DataFrame, path: str) -> int:
    """Adds the rows to a Parquet table and reads them back: fewer or more than were given is an error. Returns their number.

    They are counted while they are written, so the input is computed once.
    """
    spark, before = df.sparkSession, 0
    if _there(spark, path):
        before = spark.read.parquet(path).count()
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    n, after = seen.get["n"], spark.read.parquet(path).count()
    if after - before != n:
        raise ValueError(f"{after - before} rows of {n} arrived in {path}")
    return n


def append_ledger(entries: DataFrame, path: str, cut: str = "error", most: int = 200) -> None:
    """Appends JSON lines to a ledger; as in every ledger of attempts, the error's text is kept to its first ``most`` characters."""
    entries.withColumn(cut, F.left(cut, F.lit(most))).write.mode("append").json(path)


def write_merged(df: DataFrame, path: str, key: str, ident: str) -> None:
    """JSON lines in order of ``key`` over the files in order of their names. A row whose ``ident`` is not its key is an error."""
    if not df.where(~F.col(key).eqNullSafe(F.col(ident))).isEmpty():
        raise ValueError(f"{ident} is not {key}")
    df.repartitionByRange(key).sortWithinPartitions(key).write.json(path)


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
