"""Upsert semantics as DataFrame expressions. Keys must not be null.

Spark rows have no order of their own, so every merge takes explicit order
columns (an event id, a timestamp, or the load order the staging reads add).
Rows without an order lose against those with one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.functions.keys import require_keys
from starwright.operators.dimensions import first_per_key, latest_per_key


def keyed_last_write(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per key: the last one written wins."""
    return latest_per_key(require_keys(df, keys), keys, order, columns)


def rows_to_insert(
    target: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Insert, on conflict keep the existing row: the rows that must be appended.

    First row per key among the new ones, minus the keys already in the
    target, of which only the key columns are read.
    """
    first = first_per_key(require_keys(new, keys), keys, order, columns)
    if target is None:
        return first
    return first.join(target.select(*keys), list(keys), "left_anti").select(*columns)


def merged_rows(
    target: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    update: Sequence[str],
) -> DataFrame:
    """Insert, on conflict update some columns: the whole table after the merge.

    Per key, updated columns come from the last new row and the others from
    the existing row, or else the first new one. Target and new rows go
    through one aggregation, so each side is shuffled once and a hot key folds
    to one row per task before that.
    """
    rows = require_keys(new, keys).select(
        *columns, F.lit(1).alias("_batch"), *[F.col(o).alias(f"_{i}") for i, o in enumerate(order)]
    )
    if target is not None:
        rows = target.select(*columns, F.lit(0).alias("_batch")).unionByName(
            rows, allowMissingColumns=True
        )
    kept = [name for name in columns if name not in keys and name not in update]
    position = [F.col(f"_{i}") for i in range(len(order))]
    missing = [column.isNull().alias(f"_no{i}") for i, column in enumerate(position)]
    merged = rows.groupBy(*keys).agg(
        F.min(F.struct("_batch", *missing, *position, *kept)).alias("_first"),
        F.max(F.struct("_batch", *position, *update)).alias("_last"),
    )
    picked = {name: f"_first.{name}" for name in kept} | {name: f"_last.{name}" for name in update}
    return merged.select(*[F.col(picked.get(name, name)).alias(name) for name in columns])
