"""Registration of queries together with their SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starwright.session import prepare
from starwright.storage import remove, scratch_dir


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Tables:
    """The parquet tables of one data folder, as attributes.

    A table's schema is read from its files once and given after that.
    """

    _schemas: dict[tuple[str, str], T.StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in self._schemas:
            self._schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[key]).parquet(path)

    @contextmanager
    def source_files(self, label: str, write: Callable[[str], None]) -> Iterator[str]:
        """Files derived from the tables, for the builds that read them meanwhile.

        Every query writes its own, so that what it costs does not depend on
        the queries before it.
        """
        path = scratch_dir(self.spark, label)
        try:
            write(path)
            yield path
        finally:
            remove(self.spark, path)


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(prepare(spark), folder))

        REGISTRY[function.__name__] = Query(run, sql)
        return function

    return register
