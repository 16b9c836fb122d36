"""Keyed state on plain files, cut into buckets by a hash of the key.

A batch writes the rows of its own keys as a delta, one folder per bucket, and then a manifest: the folders that make
up the state, bucket by bucket. The manifest is one small file, so a batch is part of the state or it is not. A read asks
the manifest for the buckets of the keys at hand and opens only their folders. A bucket with many folders is merged into
one by the batch that finds it so; folders that only older manifests name are removed by the batch after that, when no
repeated batch can need them any more. Nothing is updated in place.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import remove

EXPIRES = "expires_at"


@dataclass
class StateTable:
    """``merge`` (``min`` or ``max``) makes one value of several. With ``ends`` every row carries ``expires_at``.

    The number of buckets and of deltas a bucket may have bound the manifest: choose the buckets so that one fits a task.
    """

    path: str
    keys: list[str]
    values: list[str]
    buckets: int = 64
    merge: str = "min"
    ends: bool = False
    deltas: int = 8

    def _schema(self) -> T.StructType:
        names = self.values + ([EXPIRES] if self.ends else [])
        return T.StructType([T.StructField(k, T.StringType()) for k in self.keys] + [T.StructField(v, T.LongType()) for v in names])

    def _columns(self) -> list[Column]:
        return [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema()]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int").alias("bucket")

    def _manifests(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema("bucket int, folder string, buckets int, version long").parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _live(self, spark: SparkSession, before: int | None) -> tuple[int | None, dict[int, list[str]]]:
        """Newest version below ``before`` and its folders per bucket."""
        found = self._manifests(spark)
        if found is None:
            return None, {}
        if before is not None:
            found = found.where(F.col("version") < before)
        newest = found.agg(F.max("version")).first()[0]
        parts = defaultdict(list)
        for r in found.where(F.col("version") == newest).collect() if newest is not None else []:
            if r.buckets != self.buckets:
                raise ValueError(f"the state has {r.buckets} buckets, not {self.buckets}")
            parts[r.bucket].append(r.folder)
        return newest, parts

    def _rows(self, spark: SparkSession, parts: dict[int, list[str]], now: int | None) -> DataFrame:
        """Merged rows of the given folders; those that expired by ``now`` are left out."""
        paths = [f"{self.path}/data/{folder}/bucket={b}" for b, folders in parts.items() for folder in folders]
        rows = spark.read.schema(self._schema()).parquet(*paths) if paths else spark.createDataFrame([], self._schema())
        one = {"min": F.min, "max": F.max}[self.merge]
        merged = rows.groupBy(*self.keys).agg(*[one(v).alias(v) for v in self.values], *([F.max(EXPIRES).alias(EXPIRES)] if self.ends else []))
        return merged.where(F.col(EXPIRES) > now) if self.ends and now is not None else merged

    def read(self, spark: SparkSession, before: int | None = None, only: DataFrame | None = None, now: int | None = None) -> DataFrame:
        """State made of all batches with a number below ``before``, for all keys or those of ``only``.

        With ``only`` one job finds the buckets of these keys, at most as many numbers as there are buckets, and no
        folder of another bucket is opened.
        """
        _, parts = self._live(spark, before)
        if only is None or not parts:
            return self._rows(spark, parts, now)
        wanted = {r.bucket for r in only.select(self._bucket()).distinct().collect()}
        rows = self._rows(spark, {b: f for b, f in parts.items() if b in wanted}, now)
        return rows.join(only.select(*[F.col(k).cast("string").alias(k) for k in self.keys]).distinct(), self.keys, "left_semi")

    def append(self, delta: DataFrame, batch: int, now: int | None = None) -> None:
        """Make ``delta`` part of the state as batch number ``batch``; a repeated batch replaces its own part."""
        spark = delta.sparkSession
        version, parts = self._live(spark, batch)
        self._sweep(spark, version, parts)
        folder = f"delta-{batch}"
        self._write(delta.select(*self._columns()), folder)
        full = {b: f for b, f in parts.items() if len(f) >= self.deltas}
        if full:
            self._write(self._rows(spark, full, now), f"base-{batch}")
            parts = {b: f for b, f in parts.items() if b not in full} | {b: [f"base-{batch}"] for b in self._held(spark, f"base-{batch}")}
        for b in self._held(spark, folder):
            parts[b] = [*parts.get(b, []), folder]
        rows = [(b, f, self.buckets) for b, folders in sorted(parts.items()) for f in folders]
        (spark.createDataFrame(rows, "bucket int, folder string, buckets int").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/version={batch}"))

    def _held(self, spark: SparkSession, folder: str) -> list[int]:
        """Buckets that a written folder has."""
        rows = spark.read.schema("bucket int").parquet(f"{self.path}/data/{folder}")
        return [r.bucket for r in rows.select("bucket").distinct().collect()]

    def _write(self, rows: DataFrame, folder: str) -> None:
        (rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/data/{folder}"))

    def _sweep(self, spark: SparkSession, version: int | None, parts: dict[int, list[str]]) -> None:
        """Remove what only manifests before ``version`` name, and these manifests."""
        found = self._manifests(spark) if version is not None else None
        if found is None:
            return
        old = found.where(F.col("version") < version).collect()
        kept = {(b, f) for b, folders in parts.items() for f in folders}
        gone = sorted({(r.bucket, r.folder) for r in old} - kept)
        remove(spark, [f"{self.path}/data/{f}/bucket={b}" for b, f in gone] + [f"{self.path}/manifest/version={v}" for v in sorted({r.version for r in old})])
