"""A keyed table for batches that may come twice: staged folders and one manifest a batch."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class KeyedTable:
    """One row a key, the last by ``order``. Rows lie in buckets by key hash; a batch rewrites the buckets that it touches.

    ``path``/data holds folders of buckets, ``path``/manifest a file a batch,
    which names the folder of each bucket. The batch's files are all written
    before its manifest is moved into place, under a name that no other batch
    has; readers go by the last manifest, so they see a batch whole or not at
    all, and what a lost batch left behind is never read. The paths may be in
    any store with an atomic move of a file.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str] | None = None, buckets: int = 64, immutable: bool = False):
        self.spark, self.path, self.key, self.order, self.buckets, self.immutable = spark, path.rstrip("/"), key, order or [], buckets, immutable

    # The store, by way of Spark's own file systems.

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._path("manifest").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict | None:
        """The last batch's: ``batch``, and ``of``, the folder of each bucket."""
        files, folder = self._files(), self._path("manifest")
        if not files.exists(folder):
            return None
        names = sorted(s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json"))
        return json.loads(self.spark.read.text(f"{self.path}/manifest/{names[-1]}", wholetext=True).head()[0]) if names else None

    def _commit(self, manifest: dict) -> None:
        files, staged, to = self._files(), self._path(f"manifest/{uuid.uuid4().hex}.tmp"), self._path(f"manifest/{manifest['batch']:012d}.json")
        out = files.create(staged, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if files.exists(to) or not files.rename(staged, to):
            raise ValueError(f"batch {manifest['batch']} was written by another writer")

    # Rows.

    def _folders(self, manifest: dict, buckets=None) -> list[str]:
        return [f"{self.path}/data/{folder}/bucket={b}" for b, folder in manifest["of"].items() if buckets is None or int(b) in buckets]

    def read(self) -> DataFrame | None:
        """The table as the last whole batch left it; null before the first."""
        manifest = self.manifest()
        return self.spark.read.schema(manifest["schema"]).parquet(*self._folders(manifest)) if manifest and manifest["of"] else None

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Takes a batch in; false, and nothing changes, for one that is in already. Batch ids only grow.

        Of several rows of a key in a batch the last by ``order``, then by all
        columns, counts, and it replaces the table's. Of an ``immutable`` table
        a key may only come again with equal values; otherwise it is an error,
        and nothing is written. Fits ``foreachBatch``.
        """
        old = self.manifest()
        if old and batch_id <= old["batch"]:
            return False
        rest = [c for c in batch.columns if c not in self.key]
        latest = Window.partitionBy(*self.key).orderBy(*(F.desc_nulls_last(c) for c in [*self.order, *rest] or self.key))
        if self.immutable and not batch.distinct().groupBy(*self.key).count().where("count > 1").isEmpty():
            raise ValueError("a key comes with two values in one batch")
        new = batch.withColumn("__r", F.row_number().over(latest)).where("__r = 1").drop("__r")
        new = new.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")).persist()
        try:
            touched = {r.bucket for r in new.select("bucket").distinct().collect()}  # at most as many as there are buckets
            merged, folders = new, self._folders(old, touched) if old else []
            if folders:
                kept = self.spark.read.schema(old["schema"]).parquet(*folders)
                if sorted(kept.columns) != sorted(batch.columns):
                    raise ValueError(f"columns {batch.columns}, the table has {kept.columns}")
                same = [F.col(f"k.{c}").eqNullSafe(F.col(f"n.{c}")) for c in self.key]
                pairs = kept.alias("k").join(new.alias("n"), same)
                if self.immutable and not pairs.where(~F.forall(F.array(F.lit(True), *(F.col(f"k.{c}").eqNullSafe(F.col(f"n.{c}")) for c in rest)), lambda x: x)).isEmpty():
                    raise ValueError("a key is there with other values")
                kept = kept.alias("k").join(new.alias("n"), same, "left_anti").withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
                merged = new.unionByName(kept)
            folder = f"{batch_id:012d}-{uuid.uuid4().hex}"
            if touched:
                merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
            of = (old["of"] if old else {}) | {str(b): folder for b in sorted(touched)}
            self._commit({"batch": batch_id, "of": of, "schema": old["schema"] if old else batch.schema.toDDL()})
        finally:
            new.unpersist()
        return True
