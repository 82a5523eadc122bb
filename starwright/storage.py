"""Where written intermediates go: the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


_to_remove: ContextVar[list[str] | None] = ContextVar("_to_remove", default=None)


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="starwright-")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session running in local mode may go without that setting; there a
    temporary folder stands in. On a cluster a machine-local folder would be
    invisible to the other executors, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return _local_root()
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/starwright/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    Used where a frame feeds several consumers, or must not change between
    them: it cuts the lineage, survives the loss of executors, and gives the
    optimizer exact sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if (paths := _to_remove.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    """A path and the file system it names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    folder, files = _folder(spark, pattern)
    return [str(x.getPath()) for x in files.globStatus(folder) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``written`` wrote meanwhile.

    For builds whose results are tables of their own: what they return must
    not read the intermediates any more.
    """
    token = _to_remove.set([])
    try:
        yield
    finally:
        paths = _to_remove.get()
        _to_remove.reset(token)
        for path in paths:
            remove(spark, path)


def outcome(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, written once; the intermediates that led to it are deleted."""
    path = scratch_dir(spark, label)
    if (paths := _to_remove.get()) is not None:
        paths.append(path)
    with intermediates(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)
