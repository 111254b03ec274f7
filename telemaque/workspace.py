"""Where jobs keep checkpoints and written tables: a folder every executor can reach, and small files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local-mode session without it."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="telemaque-")


def fresh_name() -> str:
    return uuid.uuid4().hex


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/telemaque/{label}-{fresh_name()}"


# -- small files, through the file systems that Spark knows ----------------------------------------


def _store(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder`` but hidden ones; none if it isn't there."""
    store, there = _store(spark, folder)
    if not store.exists(there):
        return []
    names = [status.getPath().getName() for status in store.listStatus(there)]
    return [name for name in names if not name.startswith((".", "_"))]


def get_text(spark: SparkSession, path: str) -> str:
    store, there = _store(spark, path)
    stream = store.open(there)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears at ``path`` in one step; one that is there stays as it is."""
    store, there = _store(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{there.getName()}-{fresh_name()}")
    stream = store.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.rename(draft, there):
        store.delete(draft, False)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a folder and all that is in it."""
    store, there = _store(spark, path)
    return store.getContentSummary(there).getLength()


def removed(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with what is in it; False if it wasn't there."""
    store, there = _store(spark, path)
    return store.delete(there, True)
