"""JSON and CSV reads. Schemas are always given; bad records fail the job."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ORDER = "load_order"
#: Names of JSON files, plain or compressed.
JSON_FILES = "*.{json,json.gz}"
#: What opening a file counts for, in bytes, where a source is made of very many small ones.
SMALL_FILE_COST = 64 * 1024


def load_order() -> Column:
    """Position of a row in its source: file, split, place within the split.

    Only meaningful right on a file scan, before any shuffle. Files order by
    path, rows within a file as they stand in it.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(LOAD_ORDER)


def rendered(path: str, params: Mapping[str, object] | None) -> str:
    """The path with each ``{name}`` of a parameter filled in; other braces are globs."""
    for name, value in (params or {}).items():
        path = path.replace("{" + name + "}", str(value))
    return path


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Let reads that run meanwhile put many small files into one task.

    Spark fills a task with files up to ``spark.sql.files.maxPartitionBytes``,
    each counted with its size and a cost of opening it; that cost, 4 MB by
    default, makes one task of some 30 small files. Here some 2,000 share one,
    so that a catalog of one file for each entry is read by a bounded number of
    tasks. Wrap the write that turns such files into columns, as splits are
    planned when a read runs.
    """
    option = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(option)
    spark.conf.set(option, str(SMALL_FILE_COST))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def _finish(df: DataFrame, with_load_order: bool, partitions: int | None) -> DataFrame:
    if with_load_order:
        df = df.select("*", load_order())
    return df.repartition(partitions) if partitions else df


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    recursive: bool = False,
    params: Mapping[str, object] | None = None,
    with_load_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """JSON lines from a file, a directory, a glob, (recursive) a whole tree, or a list of files.

    ``params`` fills ``{placeholders}`` in the path from the run's context.
    ``partitions`` asks for a repartitioning of the input.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", JSON_FILES)
    paths = rendered(path, params) if isinstance(path, str) else list(path)
    return _finish(reader.json(paths), with_load_order, partitions)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    delimiter: str = ",",
    ignore_headers: int = 1,
    multiline: bool = False,
    params: Mapping[str, object] | None = None,
    with_load_order: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """All CSV files below a path, or of a list, as one frame, columns by position.

    Quotes inside a quoted field are doubled. ``ignore_headers`` lines are
    skipped at the top of every file; more than one cannot be combined with
    records that span lines or with a load order.
    """
    path = rendered(path, params) if isinstance(path, str) else list(path)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "FAILFAST"}
    if ignore_headers > 1:
        if multiline or with_load_order:
            raise ValueError("several header lines exclude multiline records and a load order")
        lines = _lines_after_headers(spark, path, ignore_headers)
        parsed = lines.select(F.from_csv("value", schema.toDDL(), options).alias("record"))
        return _finish(parsed.select("record.*"), False, partitions)
    reader = spark.read.schema(schema).options(**options)
    frame = reader.csv(path, header=ignore_headers == 1, multiLine=multiline)
    return _finish(frame, with_load_order, partitions)


def _lines_after_headers(spark: SparkSession, path: str | list[str], headers: int) -> DataFrame:
    """Text lines without the first ``headers`` lines of each file.

    Headers stand in the first split of a file, and a task reads a split from
    top to bottom, so counting lines per file within the task is enough: files
    stay splittable and nothing is shuffled.
    """

    def skip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            first_split = batch["block"] == 0
            place = batch.groupby("file").cumcount() + batch["file"].map(seen).fillna(0)
            for file, lines in batch.loc[first_split, "file"].value_counts().items():
                seen[file] = seen.get(file, 0) + lines
            yield batch.loc[~first_split | (place >= headers), ["value"]]

    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines.mapInPandas(skip, "value string").filter(F.length("value") > 0)
