"""Typed staging: field mapping, coercion, and the truncate-then-load operator."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.functions.cleaning import truncate_toward_zero
from starwright.functions.timeparts import from_epoch_ms
from starwright.sinks.files import laid_out
from starwright.sinks.tables import create_table, truncate_load
from starwright.sources.files import JSON_FILES, read_csv, read_json, rendered, small_files
from starwright.sources.ledger import FileLedger, listing

# Partition columns of staging archives.
BATCH = "staged_batch"
DAY = "staged_day"


def map_fields(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Ordered (source field, target column) pairs; nested fields as ``a.b``."""
    return df.select(*[F.col(field).alias(column) for field, column in fields])


def fields_from_jsonpaths(document: str, columns: Sequence[str]) -> list[tuple[str, str]]:
    """Field list from a JSONPaths document, whose n-th path fills the n-th column.

    Paths step through objects, as ``$.a.b`` or ``$['a']['b']``.
    """
    paths = json.loads(document)["jsonpaths"]
    if len(paths) != len(columns):
        raise ValueError(f"{len(paths)} paths for {len(columns)} columns")
    step = re.compile(r"\.(\w+)|\['([^']+)'\]|\[\"([^\"]+)\"\]")
    fields = []
    for path, column in zip(paths, columns):
        steps = ["".join(parts) for parts in step.findall(path)]
        if not re.fullmatch(rf"\$(?:{step.pattern})+", path):
            raise ValueError(f"unsupported path {path!r}")
        fields.append((".".join(f"`{name}`" for name in steps), column))
    return fields


def _coerced(df: DataFrame, field: T.StructField, width: int | None) -> Column:
    value, source, target = F.col(field.name), df.schema[field.name].dataType, field.dataType
    if isinstance(target, (T.VarcharType, T.CharType)):  # as wide as it is; a write checks the width
        target = T.StringType()
    from_text = isinstance(source, T.StringType) and not isinstance(target, T.StringType)
    if from_text:
        value = F.nullif(value, F.lit(""))
    if isinstance(target, T.DecimalType) and target.scale == 0:
        if from_text:
            value = value.cast("decimal(38,10)")
        value = truncate_toward_zero(value).cast(target)
    elif isinstance(target, T.TimestampType) and isinstance(source, T.NumericType):
        value = from_epoch_ms(value)
    else:
        value = value.cast(target)
    if width is not None:
        value = F.substring(value, 1, width)
    return value.alias(field.name)


def coerce_to_schema(
    df: DataFrame, target: T.StructType, widths: Mapping[str, int] | None = None
) -> DataFrame:
    """Cast to the target's columns as a warehouse bulk load does.

    Whole-number decimals drop the fraction instead of rounding, numbers going
    into timestamps are epoch milliseconds, empty text is null in a column
    that is not text, and columns named in ``widths`` are cut to that many
    characters. Every other cast is strict.
    """
    widths = widths or {}
    return df.select(*[_coerced(df, field, widths.get(field.name)) for field in target.fields])


def staged_rows(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    target: T.StructType,
    *,
    is_json: bool = False,
    is_csv: bool = False,
    fields: Sequence[tuple[str, str]] | None = None,
    widths: Mapping[str, int] | None = None,
    delimiter: str = ",",
    ignore_headers: int = 1,
    recursive: bool = False,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rows of JSON or CSV files as a table of the ``target`` schema takes them.

    The files are read under ``schema``, ``fields`` maps them to the table's
    columns (by default same name for JSON, same position for CSV), and values
    are coerced to the table's types. Columns that the JSON files lack are null.
    """
    if is_json:
        rows = read_json(spark, path, schema, recursive=recursive, params=params)
    elif is_csv:
        rows = read_csv(
            spark, path, schema, delimiter=delimiter, ignore_headers=ignore_headers, params=params
        )
    else:
        raise ValueError("set is_json or is_csv to match the format of the files")
    if fields:
        rows = map_fields(rows, fields)
    elif is_json:
        present = {name.lower() for name in rows.columns}
        absent = [f for f in target.fields if f.name.lower() not in present]
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    elif is_csv and not is_json:
        rows = rows.toDF(*target.names)
    return coerce_to_schema(rows, target, widths)


def stage_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType, **options
) -> None:
    """Replace a staging table's rows by those of JSON or CSV files.

    Options are those of ``staged_rows``.
    """
    target = spark.table(table).schema
    with small_files(spark):
        truncate_load(staged_rows(spark, path, schema, target, **options), table)


def create_staging_archive(
    spark: SparkSession, table: str, schema: T.StructType, day: bool = False
) -> None:
    """A staging table that keeps its batches apart, and days within them."""
    extra = [T.StructField(BATCH, T.StringType())] + [T.StructField(DAY, T.DateType())] * day
    columns = T.StructType([*schema.fields, *extra])
    create_table(spark, table, columns, partition_by=[f.name for f in extra])


def stage_new_files(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    ledger: FileLedger,
    *,
    pattern: str = JSON_FILES,
    day: Column | None = None,
    params: Mapping[str, object] | None = None,
    **options,
) -> DataFrame | None:
    """Add the rows of files that were not staged before to a staging archive.

    Returns the rows added, or None if there are no new files. Each file is read once, whatever runs there are;
    what a lost run has left of a batch goes first. ``day`` is what rows are
    kept apart by, so that an interval reads its own days only. Options are
    those of ``staged_rows``.
    """
    if (lost := ledger.abandoned(table)) is not None:
        drop_batch(spark, table, lost)
    stored = spark.table(table).schema
    target = T.StructType([f for f in stored.fields if f.name not in (BATCH, DAY)])
    files = ledger.new_files(table, listing(spark, rendered(path, params), pattern))
    if not files:
        return None
    batch = ledger.open(table)
    rows = staged_rows(spark, [f["path"] for f in files], schema, target, **options)
    extra = {BATCH: F.lit(batch)} | ({DAY: day} if day is not None else {})
    rows = laid_out(rows.withColumns(extra), list(extra)[1:]).select(*stored.names)
    with small_files(spark):
        rows.write.insertInto(table)
    ledger.close(table, batch, files)
    return spark.table(table).where(F.col(BATCH) == batch).select(*target.names)


def drop_batch(spark: SparkSession, table: str, batch: str) -> None:
    """Remove the rows of a batch from a staging archive."""
    for row in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({BATCH} = '{batch}')").collect():
        parts = dict(part.split("=", 1) for part in row["partition"].split("/"))
        null = "__HIVE_DEFAULT_PARTITION__"
        spec = ", ".join(f"{k} = NULL" if v == null else f"{k} = '{v}'" for k, v in parts.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
