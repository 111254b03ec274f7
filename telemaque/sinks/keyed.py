"""A table with one row per key, kept up to date by batches: the last write wins.

Keys are dealt into buckets. A batch rewrites the buckets that its keys are in, beside the old files, and a
new version of the table is a small manifest that names the folder of each bucket. The manifest appears in
one step, so readers see a version whole or not at all, and a batch that broke off has changed nothing.
Versions carry the number of their batch: a batch that comes again finds its version, or a later one, and
is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemaque.operators.upserts import PING_ORDER, last_write
from telemaque.sinks.tables import append_sink
from telemaque.workspace import fresh_name, get_text, listed, put_text, removed

BUCKETS = 32
BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """The table under ``root``: the greatest row in ``order`` for each combination of ``keys``.

    Choose ``buckets`` so that one of them, whole, is some files of ordinary size. Rows of which all keys are
    NULL are a key of their own, as in a group.
    """

    root: str
    keys: Sequence[str]
    order: Sequence[str] = PING_ORDER
    buckets: int = BUCKETS

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(map(int, listed(spark, f"{self.root}/_versions")))

    def _manifest(self, spark: SparkSession, version: int) -> dict:
        return json.loads(get_text(spark, f"{self.root}/_versions/{version}"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, manifest: dict, buckets: Sequence[int]) -> DataFrame | None:
        folders = [f"{manifest['folders'][str(b)]}/{BUCKET}={b}" for b in buckets if str(b) in manifest["folders"]]
        if not folders:
            return None
        return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(*folders)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table as of ``version``, the last one by default."""
        versions = self.versions(spark)
        if not versions:
            raise ValueError(f"{self.root} has no version yet")
        manifest = self._manifest(spark, versions[-1] if version is None else version)
        rows = self._read(spark, manifest, range(self.buckets))
        return spark.createDataFrame([], StructType.fromJson(manifest["schema"])) if rows is None else rows

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take ``batch`` in as version ``batch_id``. One writer at a time, batches in order."""
        spark = batch.sparkSession
        versions = self.versions(spark)
        if versions and versions[-1] >= batch_id:
            return
        manifest = self._manifest(spark, versions[-1]) if versions else {"folders": {}, "schema": batch.schema.jsonValue()}
        folders = dict(manifest["folders"])
        touched = sorted(r[0] for r in batch.select(self._bucket().alias(BUCKET)).distinct().collect())  # of few buckets
        if touched:
            old = self._read(spark, manifest, touched)
            rows = batch if old is None else old.unionByName(batch)
            folder = f"{self.root}/data/{batch_id}-{fresh_name()}"
            merged = rows.transform(last_write(self.keys, self.order)).select(*batch.columns)
            append_sink(merged.withColumn(BUCKET, self._bucket()), folder, partition_by=(BUCKET,))
            folders |= {str(b): folder for b in touched}
        manifest = {"folders": folders, "schema": batch.schema.jsonValue()}
        put_text(spark, f"{self.root}/_versions/{batch_id}", json.dumps(manifest))

    def expire(self, spark: SparkSession, keep: int = 2) -> None:
        """Remove what none of the last ``keep`` versions names. Readers of older versions must be done."""
        versions = self.versions(spark)
        live = {f for v in versions[-keep:] for f in self._manifest(spark, v)["folders"].values()}
        for version in versions[:-keep]:
            removed(spark, f"{self.root}/_versions/{version}")
        for name in listed(spark, f"{self.root}/data"):
            if f"{self.root}/data/{name}" not in live:
                removed(spark, f"{self.root}/data/{name}")
