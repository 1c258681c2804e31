"""Changing state as a log-structured table: runs of changed rows in key buckets.

A batch writes the rows it changed as a run, one file set per bucket of the key
hash, and then a manifest that lists the runs live in each bucket. As soon as a
bucket has ``fan`` runs of one level they are merged, within the batch, into one
of the next level, newest row per key. So a bucket has at most ``fan - 1`` runs
a level and levels grow with the logarithm of what was written: what a batch
reads does not grow with the number of batches before it, and a row is
rewritten once a level.

The manifest is the commit: a batch that died before it has left only files
nobody reads, and running it again replaces them. A replay of batch n starts
from the manifest of the batch before n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stayflow.sources import manifest

BUCKETS = 16
FAN = 4


class StateTable:
    """Latest row per key under ``path``, as left by numbered batches."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: StructType, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.keys, self.schema, self.fan = spark, path.rstrip("/"), keys, schema, fan
        self.columns = schema.fieldNames()
        # a table keeps the buckets it was made with
        self.buckets = self._live(None).get("buckets", buckets)

    def _live(self, before: int | None) -> dict:
        """The manifest: ``runs`` lists, per bucket, (folder, level) from oldest to newest."""
        return manifest.read_version(self.spark, f"{self.path}/_manifest", before)[1] or {"runs": {}}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _stored(self, folders: list[str]) -> DataFrame:
        full = StructType([*self.schema.fields, StructField("_batch", LongType())])
        if not folders:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(*[f"{self.path}/{f}" for f in folders])

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Newest row per key: the batches are compared on the keys alone, whole rows are only picked out."""
        newest = rows.groupBy(*self.keys).agg(F.max("_batch").alias("_newest"))
        aside = newest.select(*[F.col(k).alias(f"_{k}") for k in self.keys], "_newest").hint("shuffle_hash")
        same = F.col("_batch") == F.col("_newest")
        for key in self.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        return rows.join(aside, same, "left_semi")

    def folders(self, before: int | None = None, only: DataFrame | None = None) -> list[str]:
        """The folders a read looks at; with ``only`` those of the buckets of these keys."""
        runs = self._live(before)["runs"]
        wanted = runs.keys() if only is None else {str(r[0]) for r in only.select(self._bucket()).distinct().collect()}
        return [folder for bucket in sorted(wanted & runs.keys(), key=int) for folder, _ in runs[bucket]]

    def read(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Latest row per key, as left by the batches before ``before`` (all if not given).

        ``only`` is a table of keys: no other bucket is opened and no other key's row is shuffled.
        """
        rows = self._stored(self.folders(before, only))
        if only is not None:
            rows = rows.join(only.select(*self.keys).distinct(), self.keys, "left_semi")
        return self._latest(rows).select(*self.columns)

    def _write_run(self, rows: DataFrame, run: str) -> list[str]:
        """Write a run and return its buckets."""
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/data/{run}")
        return [name.removeprefix("bucket=") for name in manifest.names(self.spark, f"{self.path}/data/{run}") if name.startswith("bucket=")]

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Write the rows a batch changed, at most one per key, merge what is due, and commit."""
        before = self._live(batch_id)
        runs = {bucket: [tuple(run) for run in of] for bucket, of in before["runs"].items()}
        name = f"{batch_id:012d}"
        for bucket in self._write_run(changes.select(*self.columns, F.lit(batch_id).cast("bigint").alias("_batch")), name):
            runs.setdefault(bucket, []).append((f"data/{name}/bucket={bucket}", 0))
        dropped = []
        level = 0
        while True:
            full = {bucket: [run for run in of if run[1] == level] for bucket, of in runs.items()}
            full = {bucket: of for bucket, of in full.items() if len(of) >= self.fan}
            if not full:
                if not any(run[1] > level for of in runs.values() for run in of):
                    break
                level += 1
                continue
            merged = f"{name}-{level + 1}"
            self._write_run(self._latest(self._stored([folder for of in full.values() for folder, _ in of])), merged)
            for bucket, of in full.items():
                dropped += [folder for folder, _ in of]
                # newer runs of lower levels stay behind it
                runs[bucket] = [r for r in runs[bucket] if r[1] > level] + [(f"data/{merged}/bucket={bucket}", level + 1)] + [r for r in runs[bucket] if r[1] < level]
            level += 1
        kept = [(n, folders) for n, folders in before.get("dropped", []) if n < batch_id] + [(batch_id, dropped)]
        manifest.write_version(self.spark, f"{self.path}/_manifest", batch_id, {"buckets": self.buckets, "runs": runs, "dropped": kept[-manifest.KEPT :]})
        # what went out of use so long ago that no version kept refers to it
        for _, folders in kept[: -manifest.KEPT]:
            for folder in folders:
                manifest.remove(self.spark, f"{self.path}/{folder}")
