"""Joins between a fact's rows and catalogs or dimensions.

No join here carries a broadcast hint. Spark broadcasts a side only when its
size is below ``spark.sql.autoBroadcastJoinThreshold``, from file sizes at
planning time or from the shuffled bytes at run time; beyond that it runs a
sort-merge join whose hot partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.operators.dimensions import Columns, renames, with_keys


def match_catalog(
    rows: DataFrame,
    catalog: DataFrame,
    on: Mapping[str, str],
    bring: Columns,
    how: str,
    *,
    together: bool = False,
) -> DataFrame:
    """Equi-join ``rows`` to ``catalog`` and bring in some catalog columns.

    ``on`` maps columns of ``rows`` to columns of ``catalog``, of the same
    types (a float never equals its double). Duplicate catalog keys fan out,
    as in any join. ``how`` is ``inner`` or ``left``; with ``left`` unmatched
    rows stay, with nulls. ``together`` asks for a merge join, whose matches of
    one key lie side by side: where keys fan out, a file of them repeats itself
    and takes little more than both sides do.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    for ours, theirs in on.items():
        types = rows.schema[ours].dataType, catalog.schema[theirs].dataType
        if types[0] != types[1]:
            raise ValueError(f"{ours} is {types[0]} but {theirs} is {types[1]}; cast one of them")
    keyed = catalog.select(
        *[F.col(theirs).alias(f"_on_{i}") for i, theirs in enumerate(on.values())],
        *[F.col(source).alias(name) for source, name in renames(bring).items()],
    )
    if together:
        keyed = keyed.hint("merge")
    equal = [rows[ours] == keyed[f"_on_{i}"] for i, ours in enumerate(on)]
    joined = rows.join(keyed, reduce(Column.__and__, equal), how)
    return joined.drop(*[f"_on_{i}" for i in range(len(on))])


def match_inner(
    rows: DataFrame, catalog: DataFrame, on: Mapping[str, str], bring: Columns, *, together: bool = False
) -> DataFrame:
    """Rows with a catalog match, one output row per match."""
    return match_catalog(rows, catalog, on, bring, "inner", together=together)


def match_left(
    rows: DataFrame, catalog: DataFrame, on: Mapping[str, str], bring: Columns, *, together: bool = False
) -> DataFrame:
    """All rows; unmatched ones carry nulls in the brought columns."""
    return match_catalog(rows, catalog, on, bring, "left", together=together)


def lookup_first(
    rows: DataFrame, catalog: DataFrame, on: Mapping[str, str], bring: Sequence[str]
) -> DataFrame:
    """All rows with at most one match: the smallest ``bring`` tuple per key.

    The catalog shrinks to one row per key before the join (folded before its
    shuffle). A hash of the keys joins along with them: an aggregated side
    that is already partitioned by the bare keys would be joined as it stands,
    a plan shape in which AQE leaves hot keys of ``rows`` unsplit.
    """
    theirs = list(on.values())
    best = (
        with_keys(catalog, theirs)
        .groupBy(*theirs)
        .agg(F.min(F.struct(*bring)).alias("_best"))
        .select(*theirs, *[F.col(f"_best.{name}").alias(name) for name in bring])
        .withColumn("_hash", F.xxhash64(*theirs))
    )
    hashed = rows.withColumn("_row_hash", F.xxhash64(*on))
    matched = match_catalog(hashed, best, {**on, "_row_hash": "_hash"}, bring, "left")
    return matched.drop("_row_hash")


def attach_dimension(
    rows: DataFrame,
    dimension: DataFrame,
    column: str,
    id_column: str,
    how: str = "left",
    dimension_column: str | None = None,
) -> DataFrame:
    """Replace a natural value by the dimension's id (``inner`` drops unmatched rows)."""
    matched = match_catalog(rows, dimension, {column: dimension_column or column}, [id_column], how)
    return matched.drop(column)
