"""Batches that arrive as many small files, kept as few large ones without a pause for readers.

Every batch is a folder of its own. Compaction rewrites runs of small batches as one folder of files of a wanted
size, and then switches to it by a manifest that appears in one step: it names the folders that hold the batches up
to some number. Readers take the folders of the last manifest, and the batches after it. A rewrite that breaks off
has changed nothing; folders that no manifest names any more are removed later, when no reader needs them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from telemaque.workspace import fresh_name, get_text, listed, put_text, removed, size_of

TARGET_BYTES = 128 << 20
BATCH = "batch_id"


@dataclass(frozen=True)
class CompactedTable:
    """Parquet batches under ``root``, of the given schema."""

    root: str
    schema: StructType
    target_bytes: int = TARGET_BYTES

    def _batch(self, number: int) -> str:
        return f"{self.root}/batches/{BATCH}={number}"

    def batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(name.partition("=")[2]) for name in listed(spark, f"{self.root}/batches"))

    def generations(self, spark: SparkSession) -> list[int]:
        return sorted(map(int, listed(spark, f"{self.root}/_manifests")))

    def manifest(self, spark: SparkSession, generation: int | None = None) -> dict:
        """``through``: the last batch that ``folders`` (path and bytes of each) hold."""
        generations = self.generations(spark)
        if not generations:
            return {"through": -1, "folders": []}
        return json.loads(get_text(spark, f"{self.root}/_manifests/{generations[-1] if generation is None else generation}"))

    def write(self, batch: DataFrame, number: int) -> None:
        """Store a batch; one that comes again replaces its first attempt, unless it is compacted already."""
        if number > self.manifest(batch.sparkSession)["through"]:
            batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._batch(number))

    def read(self, spark: SparkSession) -> DataFrame:
        manifest = self.manifest(spark)
        folders = [f["path"] for f in manifest["folders"]]
        folders += [self._batch(n) for n in self.batches(spark) if n > manifest["through"]]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def compact(self, spark: SparkSession) -> int:
        """Rewrite what is small. Batches up to the last one must be whole; later ones may be written meanwhile.

        Folders that hold a file of the wanted size stay as they are; the others are put together, in order, until
        they fill one. Returns the number of the generation that holds now.
        """
        manifest, generations = self.manifest(spark), self.generations(spark)
        newer = [n for n in self.batches(spark) if n > manifest["through"]]
        now = generations[-1] if generations else -1
        if not newer:
            return now
        parts = manifest["folders"] + [{"path": self._batch(n), "bytes": size_of(spark, self._batch(n))} for n in newer]
        folders: list[dict] = []
        group: list[dict] = []

        def flush() -> None:
            if len(group) == 1:
                folders.append(group[0])
            elif group:
                path = f"{self.root}/data/{fresh_name()}"
                total = sum(p["bytes"] for p in group)
                rows = spark.read.schema(self.schema).parquet(*[p["path"] for p in group])
                rows.repartition(max(1, -(-total // self.target_bytes))).write.parquet(path)
                folders.append({"path": path, "bytes": size_of(spark, path)})
            group.clear()

        for part in parts:
            if part["bytes"] >= self.target_bytes:
                flush()
                folders.append(part)
                continue
            group.append(part)
            if sum(p["bytes"] for p in group) >= self.target_bytes:
                flush()
        flush()
        put_text(spark, f"{self.root}/_manifests/{now + 1}", json.dumps({"through": newer[-1], "folders": folders}))
        return now + 1

    def expire(self, spark: SparkSession) -> None:
        """Remove the folders and manifests that the last generation has left behind."""
        generations, manifest = self.generations(spark), self.manifest(spark)
        live = {f["path"] for f in manifest["folders"]}
        for generation in generations[:-1]:
            removed(spark, f"{self.root}/_manifests/{generation}")
        old = [self._batch(n) for n in self.batches(spark) if n <= manifest["through"]]
        for path in (*old, *(f"{self.root}/data/{name}" for name in listed(spark, f"{self.root}/data"))):
            if path not in live:
                removed(spark, path)
