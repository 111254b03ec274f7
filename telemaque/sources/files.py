"""JSON files, one object per line or (``multi_line``) one pretty-printed object per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Without a schema one is inferred, which reads the files once more."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", multi_line).json(path)
