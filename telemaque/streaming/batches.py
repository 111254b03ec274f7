"""Micro-batch callbacks, for formats and operators that have no streaming form.

``df.writeStream.foreachBatch(batch_writer(...))``. Where the file sink will do, use
:mod:`telemaque.streaming.runner`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from telemaque.operators.codec import Transform


def batch_writer(
    target: str, fmt: str = "parquet", transform: Transform | None = None, **options: str
) -> Callable[[DataFrame, int], None]:
    """Write each batch, after ``transform``, into its own folder ``<target>/batch_id=<n>``.

    A batch that is run again replaces what its first attempt left, so retries neither lose nor
    double rows. Errors are raised: Spark then retries the batch. An empty batch writes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch if transform is None else batch.transform(transform)
        rows.write.mode("overwrite").format(fmt).options(**options).save(f"{target}/batch_id={batch_id}")

    return write
