"""Dimension tables: distinct, best-per-key, calendar, and dense surrogate ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.functions.timeparts import calendar_parts
from starwright.storage import written

Columns = Sequence[str] | Mapping[str, str]


def renames(columns: Columns) -> dict[str, str]:
    """Source name -> new name, in order."""
    return dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}


def pick(df: DataFrame, columns: Columns) -> DataFrame:
    """Select columns in order; a mapping (source name -> new name) renames them."""
    return df.select(*[F.col(source).alias(name) for source, name in renames(columns).items()])


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all set, as filters the scan can take over."""
    return reduce(lambda rows, key: rows.filter(F.col(key).isNotNull()), keys, df)


def distinct_dimension(df: DataFrame, columns: Columns) -> DataFrame:
    """One row per distinct combination. Duplicates fold before the shuffle."""
    return pick(df, columns).distinct()


def ranked_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    columns: Columns,
    *,
    drop_null_keys: bool = True,
) -> DataFrame:
    """The first row per key in the given order.

    Rows with a null key are dropped, or else count as one more key.

    ``order`` should spell out null placement and end in a tiebreak. Spark
    limits each key to one row per input task before the shuffle, so a key
    that holds a large share of the rows does not fill one task.
    """
    names = list(columns)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    rows = with_keys(df, keys) if drop_null_keys else df
    ranked = rows.withColumn("_rank", rank)
    return pick(ranked.filter(F.col("_rank") == 1).select(*names), columns)


def _extreme_per_key(
    df: DataFrame, keys: Sequence[str], positions: Sequence[Column], columns: Columns, pick_one
) -> DataFrame:
    """One row per key by an aggregate over (position, other columns)."""
    renamed = renames(columns)
    others = [name for name in renamed if name not in keys]
    row = F.struct(
        *[position.alias(f"_position_{i}") for i, position in enumerate(positions)], *others
    )
    best = df.groupBy(*keys).agg(pick_one(row).alias("_row"))
    return best.select(
        *[
            F.col(f"_row.{source}" if source in others else source).alias(name)
            for source, name in renamed.items()
        ]
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Columns,
    *,
    drop_null_keys: bool = True,
) -> DataFrame:
    """The row with the greatest ``order`` columns per key; nulls count as oldest.

    Rows that are equal in the order fall back to the greater of the chosen
    columns, so the result does not depend on how the rows were distributed.
    One aggregation with partial results: a hot key folds to one row per task
    before the shuffle.
    """
    rows = with_keys(df, keys) if drop_null_keys else df
    return _extreme_per_key(rows, keys, [F.col(name) for name in order], columns, F.max)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Columns
) -> DataFrame:
    """The row with the smallest ``order`` columns per key; nulls count as last."""
    positions = [part for name in order for part in (F.col(name).isNull(), F.col(name))]
    return _extreme_per_key(with_keys(df, keys), keys, positions, columns, F.min)


def time_dimension(
    df: DataFrame,
    timestamp: str,
    *,
    weekday_encoding: str,
    dedupe: bool = True,
    name: str = "start_time",
) -> DataFrame:
    """Calendar parts per timestamp.

    The parts depend on the timestamp alone, so duplicates are removed on that
    single column, before the parts are computed.
    """
    stamps = df.select(F.col(timestamp).alias(name))
    if dedupe:
        stamps = stamps.distinct()
    return stamps.withColumns(calendar_parts(F.col(name), weekday_encoding))


def numbered(df: DataFrame, id_column: str, start: int = 1) -> DataFrame:
    """Add gapless ids from ``start`` on, in the order the rows stand in.

    The rows are written once, so that ids cannot change between consumers. A
    row's id is its place in its partition plus the number of rows in the
    partitions before it; the only data that comes together in one task is one
    row count per partition.
    """
    place = F.monotonically_increasing_id()  # partition number above bit 33, place below
    rows = written(
        df.withColumn("_part", F.shiftright(place, 33)).withColumn(
            "_place", place.bitwiseAND(F.lit((1 << 33) - 1))
        ),
        f"numbered-{id_column}",
    )
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", before.alias("_offset"))
    )
    return (
        rows.join(offsets, "_part")  # one row per partition of the write
        .withColumn(id_column, F.col("_offset") + F.col("_place") + F.lit(start).cast("long"))
        .drop("_part", "_place", "_offset")
    )


def surrogate_key(df: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Add ids 1..n in the order of ``keys``, without a single-partition sort.

    Range partitioning puts the keys in order across partitions, a local sort
    within them; ``numbered`` does the rest.
    """
    return numbered(df.repartitionByRange(*keys).sortWithinPartitions(*keys), id_column)


def new_surrogates(
    stored: DataFrame, df: DataFrame, column: str, id_column: str
) -> DataFrame:
    """The values of a column that a stored dimension lacks, under the ids that come next.

    Ids that were given stay with their values, so facts that hold them stay
    right; new values follow the greatest id in their natural order. Of the
    stored rows the values are read for the anti-join and the ids for their
    greatest. One writer at a time, as for any such table.
    """
    values = with_keys(df.select(column), [column]).distinct()
    unknown = values.join(stored.select(column), column, "left_anti")
    last = stored.agg(F.max(id_column).alias("last")).first()["last"] or 0
    ordered = unknown.repartitionByRange(column).sortWithinPartitions(column)
    return numbered(ordered, id_column, last + 1)


def dimension_with_id(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """Distinct non-null values of a column with ids 1..n in natural order.

    The dimension comes back as a written table: joins to it see its true size
    and broadcast it, or not, by that.
    """
    values = with_keys(df.select(column), [column]).distinct()
    return written(surrogate_key(values, [column], id_column), f"dimension-{id_column}")
