"""Session helpers: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    The folder is the session's ``spark.checkpoint.dir``. Only where none is
    set, as in local tests, a temporary one is made.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, max_rows: int = 300_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows.

    For narrow, already written tables only. Above the bound the hint is left
    out and Spark joins by shuffle.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def skew_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, how: str = "inner", top: int = 1000) -> DataFrame:
    """``left`` joined to ``right``, whose keys are unique and whose column ``weight`` tells how many rows of ``left`` have them.

    The ``top`` heaviest keys are broadcast, a number that no input changes, and
    their rows stay where they are. Every other key has less than one in ``top``
    of the rows, so a join by shuffle deals these evenly. Both sides are read
    twice and should be written tables or cheap. ``how`` is inner or left.
    """
    hot = right.orderBy(F.desc(weight), *on).limit(top)
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(right, on, how)
    return left.join(F.broadcast(hot), on).unionByName(rest)


def lookup(left: DataFrame, right: DataFrame, on: list[str], weight: str, how: str = "inner", max_rows: int = 300_000) -> DataFrame:
    """As ``skew_join``, but ``right``, a written table, is broadcast whole while it has at most ``max_rows`` rows."""
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, weight, how)


def width(spark: SparkSession) -> int:
    """Partitions for an explicit repartition: what the session shuffles by."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, or, in a local session that sets none, a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="traceloom-"))
    return sc.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Let executors import this package, where their PYTHONPATH does not have it already."""
    root = Path(__file__).resolve().parent
    if str(root.parent) in os.environ.get("PYTHONPATH", "").split(":") or spark.sparkContext.applicationId in _shipped:
        return
    at = Path(tempfile.mkdtemp(prefix="traceloom-")) / "traceloom.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in root.rglob("*.py"):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(at))
    _shipped.add(spark.sparkContext.applicationId)


_shipped: set[str] = set()
