"""The stored optimisation table, the metrics file and the per-day result cache."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import METRICS_SCHEMA, OPTIMISATION_SCHEMA
from coldloop.session import scratch_path


@dataclass
class OptimisationStore:
    """Parquet table of controller results, one folder per date."""

    spark: SparkSession
    path: str

    def create(self) -> None:
        """Makes the table if it is absent and leaves an existing one alone."""
        empty = self.spark.createDataFrame([], OPTIMISATION_SCHEMA)
        empty.write.mode("ignore").partitionBy("d").parquet(self.path)

    def clear(self) -> None:
        empty = self.spark.createDataFrame([], OPTIMISATION_SCHEMA)
        self._write(empty, "static")

    def replace(self, rows: DataFrame) -> None:
        """The table holds these rows only: emptying and filling are one overwrite."""
        self._write(rows, "static")

    def upsert(self, rows: DataFrame) -> None:
        """Replaces the asset-days present in ``rows`` and keeps all others.

        Only the dates in ``rows`` are rewritten, together with what other assets have there. The
        new content is complete in the shared folder before a date is touched.
        """
        rows = rows.select(*OPTIMISATION_SCHEMA.names)
        days = rows.select("asset_id", "d").distinct()
        # An equi-join on the partition column: untouched dates are not read where Spark prunes.
        others = (
            self.read().join(rows.select("d").distinct(), "d", "left_semi")
            .join(days, ["asset_id", "d"], "left_anti").select(*OPTIMISATION_SCHEMA.names))
        path = scratch_path(self.spark, "upsert")
        others.unionByName(rows).write.parquet(path)
        self._write(self.spark.read.schema(OPTIMISATION_SCHEMA).parquet(path), "dynamic")

    def read(self) -> DataFrame:
        return self.spark.read.schema(OPTIMISATION_SCHEMA).parquet(self.path)

    def _write(self, rows: DataFrame, overwrite: str) -> None:
        # Rebalancing merges a date's small pieces and splits a date that is too large.
        (rows.select(*OPTIMISATION_SCHEMA.names).hint("rebalance", "d")
         .write.mode("overwrite").option("partitionOverwriteMode", overwrite)
         .partitionBy("d").parquet(self.path))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Model metrics as CSV with a header line in every file."""
    (metrics.select(*METRICS_SCHEMA.names)
     .toDF("Modèle", "Cible", "MAE", "RMSE")
     .write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Reads without a header, so header lines arrive as rows and are dropped by name.

    A missing name is kept. Errors stay text, as in the file.
    """
    rows = spark.read.csv(path, schema=METRICS_SCHEMA, header=False, encoding="UTF-8")
    is_header = F.coalesce(F.col("model").rlike("(?iu)modèle"), F.lit(False))
    return rows.where(~is_header)


@dataclass
class DayCache:
    """Day results per variant, each asset-day computed once.

    Every call appends one batch: first its rows, sorted by date, then its keys. Rows count only once
    their keys are there, so a failed batch leaves nothing visible. Where overlapping calls
    stored the same asset-day, the smallest batch is the one that is read. Days without a
    result have a key and no rows. A reloaded model is a new ``variant``.

    ``compact`` merges a variant's batches into one, in ranges of dates, whose name sorts before
    theirs. What it replaces is noted and stays until ``vacuum``, so reads under way end well.
    ``forget`` removes all of a variant, as when its model is replaced.
    """

    spark: SparkSession
    path: str
    row_schema: T.StructType

    _KEYS = T.StructType([
        T.StructField("asset_id", T.LongType()), T.StructField("d", T.DateType()),
        T.StructField("variant", T.StringType()), T.StructField("batch", T.StringType())])

    _REPLACED = "variant string, batch string, at double"

    def __post_init__(self) -> None:
        self._rows = T.StructType(
            self.row_schema.fields + [self._KEYS["variant"], self._KEYS["batch"]])
        for name, schema in (("keys", self._KEYS), ("rows", self._rows)):
            (self.spark.createDataFrame([], schema).write.mode("ignore")
             .partitionBy("variant", "batch").parquet(f"{self.path}/{name}"))

    def _read(self, name: str, schema: T.StructType, variant: str) -> DataFrame:
        table = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return table.where(F.col("variant") == variant)

    def missing(self, requested: DataFrame, variant: str) -> DataFrame:
        known = self._read("keys", self._KEYS, variant)
        return requested.select("asset_id", "d").distinct().join(
            known, ["asset_id", "d"], "left_anti")

    def fetch(self, requested: DataFrame, variant: str,
              compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Computes the asset-days not stored yet, then reads all requested ones."""
        batch = f"variant={variant}/batch={uuid.uuid4().hex}"
        missing = self.missing(requested, variant)
        if not missing.isEmpty():
            rows = compute(missing).select(*self.row_schema.names)
            rows.sortWithinPartitions("d").write.parquet(f"{self.path}/rows/{batch}")
            missing.write.parquet(f"{self.path}/keys/{batch}")
        keys = self._winners(variant).join(
            requested.select("asset_id", "d"), ["asset_id", "d"], "left_semi")
        stored = self._read("rows", self._rows, variant)
        return stored.join(keys, ["asset_id", "d", "batch"], "left_semi").select(
            *self.row_schema.names)

    def _winners(self, variant: str) -> DataFrame:
        return self._read("keys", self._KEYS, variant).groupBy("asset_id", "d").agg(
            F.min("batch").alias("batch"))

    def compact(self, variant: str) -> int:
        """Merges a variant's batches and returns how many there were; one alone stays as it is.

        Like a fetch, a merge writes rows first and keys last, so one that fails changes nothing.
        Batches that appear meanwhile are left for the next merge.
        """
        batches = sorted(r.batch for r in self._read("keys", self._KEYS, variant)
                         .select("batch").distinct().collect())  # one row per fetch
        if len(batches) < 2:
            return len(batches)
        # "-" sorts before every hexadecimal digit, a later merge before an earlier one.
        merged = f"-{(1 << 63) - time.time_ns():019d}{uuid.uuid4().hex}"
        winners = self._winners(variant).where(F.col("batch").isin(batches))
        (self._read("rows", self._rows, variant).join(winners, ["asset_id", "d", "batch"], "left_semi")
         .select(*self.row_schema.names).repartitionByRange("d").sortWithinPartitions("d", "asset_id")
         .write.parquet(f"{self.path}/rows/variant={variant}/batch={merged}"))
        replaced = self.spark.createDataFrame(
            [(variant, b, time.time()) for b in batches], self._REPLACED)
        keys = winners.select("asset_id", "d").hint("rebalance")
        keys.write.parquet(f"{self.path}/keys/variant={variant}/batch={merged}")
        replaced.coalesce(1).write.mode("append").parquet(f"{self.path}/replaced")
        return len(batches)

    def vacuum(self, older_than: float = 86_400.0) -> int:
        """Removes batches that were merged at least ``older_than`` seconds ago; how many.

        Keys go before rows: a batch without keys is not read.
        """
        if not self._exists("replaced"):
            return 0
        old = self.spark.read.schema(self._REPLACED).parquet(f"{self.path}/replaced").where(
            F.col("at") <= time.time() - older_than).select("variant", "batch").distinct().collect()
        gone = [f"variant={r.variant}/batch={r.batch}" for r in old]
        gone = [folder for folder in gone if self._exists(f"rows/{folder}")]
        for name in ("keys", "rows"):
            for folder in gone:
                self._delete(f"{name}/{folder}")
        return len(gone)

    def forget(self, variant: str) -> None:
        """Removes a variant; its days are computed again when they are asked for."""
        for name in ("keys", "rows"):
            self._delete(f"{name}/variant={variant}")

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, name: str) -> bool:
        files, path = self._at(name)
        return files.exists(path)

    def _delete(self, name: str) -> None:
        files, path = self._at(name)
        files.delete(path, True)
