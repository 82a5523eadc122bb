"""Catalog tables: create, drop, truncate-load, append, upsert.

Columns are matched by position, as ``INSERT INTO t SELECT ...`` does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.operators.dimensions import numbered
from starwright.operators.intervals import interval_slice, semimonthly_bounds
from starwright.operators.merges import merged_rows, rows_to_insert
from starwright.sinks.files import laid_out
from starwright.sinks.merge_targets import (
    MergeTarget,
    ledger_name,
    merge_target,
    properties,
    set_property,
)
from starwright.storage import folders, remove, written

RUN_COLUMN = "load_until"
#: Between a table's first directory and the name of a later version.
VERSION = "__v-"
#: Writes ids as differences, of which serials of one task have a single one; else each takes its eight bytes.
DELTAS = {"parquet.writer.version": "PARQUET_2_0"}


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create a database if missing, at ``location`` or else in the session's warehouse."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    return name


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Create a parquet table if it does not exist, with writer options such as ``DELTAS``."""
    partitioned = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in (options or {}).items())
    written_as = f" OPTIONS ({listed})" if listed else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema.toDDL()}) USING parquet{written_as}{partitioned}"
    )


def _location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return details.filter(F.col("col_name") == "Location").first()["data_type"].rstrip("/")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all versions of its files that ``replace_contents`` has left."""
    root = None
    if spark.catalog.tableExists(table.replace("`", "")):
        current = _location(spark, table)
        root = current.split(VERSION)[0] if VERSION in current else None
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {ledger_name(table)}")
    if root:
        remove(spark, root)
        for version in folders(spark, f"{root}{VERSION}*"):
            remove(spark, version)


def recreate_table(
    spark: SparkSession, table: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> None:
    drop_table(spark, table)
    create_table(spark, table, schema, options=options)


def positional(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give the columns the target's names and types, by position."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a target of {len(schema.fields)}")
    renamed = df.toDF(*schema.names)
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _insert(
    df: DataFrame,
    table: str,
    overwrite: bool,
    cluster_by: Sequence[str] = (),
    sort_key: Sequence[str] = (),
) -> None:
    rows = positional(df, df.sparkSession.table(table).schema)
    laid_out(rows, cluster_by=cluster_by, range_by=sort_key).write.insertInto(
        table, overwrite=overwrite
    )


def truncate_load_times(
    stamps: DataFrame, times: Callable[[DataFrame], DataFrame], table: str, sort_key: str
) -> None:
    """Replace a table by ``times`` of stamps, repeated ones included, in ranges of them.

    ``stamps`` has the one column ``sort_key``, and ``times`` maps its rows one
    by one. Each stamp is shuffled once for ``STAMPS_TOGETHER`` of its rows,
    with their number, and repeated and mapped in the task that writes it.
    """
    counted = stamps.groupBy(sort_key).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {STAMPS_TOGETHER}")))
    parts = counted.select(sort_key, "_n", parts.alias("_part"))
    rows = F.least(F.col("_n") - F.col("_part") * STAMPS_TOGETHER, F.lit(STAMPS_TOGETHER))
    parts = written(parts.select(sort_key, "_part", rows.alias("_rows")), "stamps")
    total = parts.agg(F.sum("_rows").alias("n")).first()["n"] or 0
    tasks = min(stamps.sparkSession.sparkContext.defaultParallelism, total // STAMPS_PER_TASK)
    files = max(-(-total // STAMPS_PER_FILE), tasks, 1)
    placed = parts.repartitionByRange(files, sort_key, "_part").sortWithinPartitions(sort_key)
    repeated = placed.select(sort_key, F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    truncate_load(times(repeated.select(sort_key)), table)


def truncate_load(
    df: DataFrame, table: str, cluster_by: Sequence[str] = (), sort_key: Sequence[str] = ()
) -> None:
    """Replace all rows of a table. The new rows must not come from the table itself.

    ``cluster_by`` brings equal values together, for lookups; ``sort_key`` gives
    files ranges that do not overlap, for scans of a range.
    """
    _insert(df, table, True, cluster_by, sort_key)


def _rows(spark: SparkSession, query: str | DataFrame) -> DataFrame:
    return spark.sql(query) if isinstance(query, str) else query


def load_dimension(spark: SparkSession, table: str, query: str | DataFrame) -> None:
    """Truncate a dimension and load it from a query."""
    truncate_load(_rows(spark, query), table)


def append(df: DataFrame, table: str, sort_key: Sequence[str] = ()) -> None:
    """Add rows to a table; with ``sort_key``, in files whose ranges do not overlap."""
    _insert(df, table, False, sort_key=sort_key)


def load_fact_interval(
    spark: SparkSession, table: str, query: str | DataFrame, timestamp: str, execution: date
) -> None:
    """Append the query's rows of the run's interval. Running an interval twice doubles it."""
    append(interval_slice(_rows(spark, query), timestamp, *semimonthly_bounds(execution)), table)


def replace_fact_interval(
    spark: SparkSession, table: str, query: str | DataFrame, timestamp: str, execution: date
) -> None:
    """Load the run's interval so that running it again changes nothing.

    The table is partitioned by ``load_until``; each run overwrites its own
    partition and leaves the others alone, also when it has no rows.
    """
    columns = [f for f in spark.table(table).schema.fields if f.name != RUN_COLUMN]
    rows = interval_slice(_rows(spark, query), timestamp, *semimonthly_bounds(execution))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} "
        f"PARTITION ({RUN_COLUMN} = DATE '{execution.isoformat()}') SELECT * FROM {{rows}}",
        rows=positional(rows, T.StructType(columns)),
    )


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def replace_contents(df: DataFrame, table: str, *, keep_previous: bool = True) -> None:
    """Point a table to a new version of its files; may read the table itself.

    Parquet files cannot be overwritten while they are read, so the rows go
    into a new directory and the table moves there once all of it is written.
    The directory before it stays, for readers still on it, unless
    ``keep_previous`` is off; those before that go.
    """
    spark = df.sparkSession
    current = _location(spark, table)
    root = current.split(VERSION)[0]
    version = f"{root}{VERSION}{uuid.uuid4().hex}"
    older = [x for x in (root, *folders(spark, f"{root}{VERSION}*")) if _name(x) != _name(current)]
    positional(df, spark.table(table).schema).write.parquet(version)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(table)
    for past in older if keep_previous else [*older, current]:
        remove(spark, past)


def _merge_target(spark: SparkSession, table: str, keys: Sequence[str]) -> MergeTarget | None:
    found = merge_target(spark, table)
    if found is not None and set(found.keys) != set(keys):
        raise ValueError(f"{table} merges by {found.keys}, not by {list(keys)}")
    return found


def upsert_ignore(new: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Insert rows with new keys; on conflict do nothing. Existing files stay as they are.

    A merge target is asked by its ledger of keys, a plain table by all its keys.
    """
    if (merge := _merge_target(new.sparkSession, table, keys)) is not None:
        return merge.insert_new(new, order)
    target = new.sparkSession.table(table)
    append(rows_to_insert(target, new, keys, order, target.columns), table)


def upsert_update(
    new: DataFrame,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
    *,
    keep_previous: bool = True,
) -> None:
    """Insert rows with new keys; on conflict set the ``update`` columns.

    A merge target rewrites the buckets that the new rows are in, a plain table
    itself; only there ``keep_previous`` leaves the files before.
    """
    if (merge := _merge_target(new.sparkSession, table, keys)) is not None:
        return merge.update(new, order, update)
    target = new.sparkSession.table(table)
    merged = merged_rows(target, new, keys, order, target.columns, update)
    replace_contents(merged, table, keep_previous=keep_previous)


#: Rows of one stamp that a shuffle moves as one, rows that a file of stamps is meant for, and rows worth a task
#: of their own where fewer files would leave cores idle.
STAMPS_TOGETHER = 1 << 10
STAMPS_PER_FILE = 1 << 24
STAMPS_PER_TASK = 1 << 20
#: Table property: the first id that no append has taken or reserved.
SERIAL_PROPERTY = "starwright.serial.next"
#: Tasks whose ids of one append lie side by side, and rows that a task may number.
SERIAL_TASKS = 1 << 17
SERIAL_ROWS = 1 << 30


def _first_free_serial(spark: SparkSession, table: str, serial: str) -> int:
    """From the table's property; the greatest id is looked for once, in a table that has none yet."""
    stored = properties(spark, table).get(SERIAL_PROPERTY)
    if stored is not None:
        return int(stored)
    last = spark.table(table).agg(F.max(serial).alias("last")).first()["last"]
    return (last or 0) + 1


def append_with_serial(df: DataFrame, table: str, serial: str, *, gapless: bool = False) -> None:
    """Append rows under ids of their own, greater than all before, in one write.

    Each task numbers its rows in a block of its own, one id in every
    ``SERIAL_TASKS``, so nothing is counted before and ids have gaps. The range
    of ids is reserved in the table's properties before the write and given
    back but for what the write has used, as the write itself reports; an
    append that finds the reservation of another one goes on behind it.

    ``gapless`` gives consecutive ids in the order the rows stand in, for which
    they are written twice.
    """
    spark = df.sparkSession
    start = _first_free_serial(spark, table, serial)
    reserved = start + SERIAL_TASKS * SERIAL_ROWS
    set_property(spark, table, SERIAL_PROPERTY, str(reserved))
    if gapless:
        rows = numbered(df, serial, start)
    else:
        place = F.monotonically_increasing_id()  # partition number above bit 33, place below
        task, row = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
        fits = (task < SERIAL_TASKS) & (row < SERIAL_ROWS)
        own = F.when(fits, F.lit(start) + row * SERIAL_TASKS + task)
        failed = F.raise_error(F.lit("more tasks or rows than serial blocks")).cast("long")
        rows = df.withColumn(serial, F.coalesce(own, failed))
    used = Observation(f"serial-{uuid.uuid4().hex}")
    rows = rows.select(serial, *df.columns).observe(used, F.max(serial).alias("last"))
    append(rows, table)
    if int(properties(spark, table)[SERIAL_PROPERTY]) == reserved:
        last = used.get["last"]
        set_property(spark, table, SERIAL_PROPERTY, str(start if last is None else last + 1))
