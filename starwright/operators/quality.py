"""The non-empty check."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def row_count_report(df: DataFrame, table: str) -> DataFrame:
    """One row: table name, number of rows, and whether there are any."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"), "n_rows", (F.col("n_rows") > 0).alias("passed")
    )


def id_counts(df: DataFrame, column: str, apart: int) -> DataFrame:
    """One row: the number of rows, and how many different whole numbers a column holds.

    Exact for any numbers, of which each 64 that lie ``apart`` from the next
    are one mask: ids that a task numbers in steps of ``apart``, a power of two,
    come together where they are read, and 64 of them are shuffled as one row.
    """
    block, place = F.col(column).bitwiseAND(F.lit(apart - 1)), F.shiftright(column, apart.bit_length() - 1)
    bit = F.expr("shiftleft(1L, CAST(_place & 63 AS INT))")
    masks = (
        df.select(block.alias("_block"), place.alias("_place"))
        .groupBy("_block", F.shiftright("_place", 6).alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.bit_or(bit).alias("_mask"))
    )
    return masks.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.bit_count("_mask").cast("long")), F.lit(0)).alias("n_ids"),
    )


def non_empty_check(spark: SparkSession, table: str) -> int:
    """Number of rows of a table; an error if it is missing or empty."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"quality check failed: table {table} does not exist")
    n_rows = spark.table(table).count()
    if n_rows < 1:
        raise ValueError(f"quality check failed: table {table} has 0 rows")
    log.info("quality check passed: table %s has %d rows", table, n_rows)
    return n_rows


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A frame that counts its rows while they are written, and where the count will be."""
    counts = Observation(name)
    return df.observe(counts, F.count(F.lit(1)).alias("n_rows")), counts


def loaded_check(spark: SparkSession, table: str, counts: Observation) -> int:
    """Rows that a write has just loaded, from the write itself.

    Nothing is read again unless there were none; that is reported, and an
    error if the table holds no rows of before either.
    """
    n_rows = counts.get["n_rows"]
    if n_rows < 1:
        held = non_empty_check(spark, table)
        log.warning("quality check: nothing loaded into table %s, which holds %d rows", table, held)
    else:
        log.info("quality check passed: %d rows loaded into table %s", n_rows, table)
    return n_rows
