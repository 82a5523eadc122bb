"""Parquet, JSON and CSV output with control over layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

#: Rows of a compressed text file, which one task reads as a whole.
ROWS_PER_TEXT_FILE = 1 << 20


def laid_out(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
    cluster_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    range_by: Sequence[str] = (),
) -> DataFrame:
    """Distribute rows for a write.

    Rows that belong together (a partition directory, a clustering key) are
    rebalanced: AQE packs small groups together and splits a hot one over
    several tasks, so a write makes few files and no task gets a third of the
    data. ``max_files`` repartitions at the end instead of narrowing the stages
    before it, so only the write itself runs with that little parallelism.

    ``range_by`` cuts the rows in the order of these columns by sampled bounds,
    so that files hold ranges that at most touch, and a range filter skips the
    files outside it. Rows of one value lie in the order of a hash of all their
    columns and are cut there too, so that a hot value fills several files. AQE
    merges only ranges that are next to each other.
    """
    together = [*partition_by, *cluster_by]
    if range_by:
        if together or max_files is not None:
            raise ValueError("ranges exclude partitions, clusters and a number of files")
        spread = F.xxhash64(*df.columns)
        return df.repartitionByRange(*range_by, spread).sortWithinPartitions(*range_by, *sort_by)
    if max_files is not None:
        df = df.repartition(max_files)
    elif together:
        df = df.hint("rebalance", *together)
    order = list(dict.fromkeys([*together, *sort_by])) if cluster_by or sort_by else []
    return df.sortWithinPartitions(*order) if order else df


def _writer(
    df: DataFrame,
    partition_by: Sequence[str],
    max_files: int | None,
    cluster_by: Sequence[str],
    sort_by: Sequence[str],
    keep_partition_columns: bool,
    mode: str,
    range_by: Sequence[str] = (),
    compression: str | None = None,
    in_place: bool = False,
) -> DataFrameWriter:
    if keep_partition_columns:
        df = df.withColumns({f"{name}p": F.col(name) for name in partition_by})
        partition_by = [f"{name}p" for name in partition_by]
    rows = df if in_place else laid_out(df, partition_by, max_files, cluster_by, sort_by, range_by)
    writer = rows.write.mode(mode)
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=ROWS_PER_TEXT_FILE)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
    cluster_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    range_by: Sequence[str] = (),
    keep_partition_columns: bool = False,
    mode: str = "overwrite",
    in_place: bool = False,
) -> None:
    """Parquet files, optionally partitioned, bounded in number, clustered, or in ranges.

    ``cluster_by`` brings equal values together, sorted by them and then by
    ``sort_by``, with bloom filters that let a lookup by them skip row groups.
    ``range_by`` gives each file a range of its own of these columns instead,
    which lets a range of them skip files.
    ``keep_partition_columns`` partitions by copies (``yearp`` for ``year``),
    so that the columns themselves stay in the files. ``in_place`` writes rows
    where they are, a file for each task and partition: for joins that make far
    more rows than they read, which a shuffle would move one by one.
    """
    if in_place and (max_files is not None or cluster_by or sort_by or range_by):
        raise ValueError("rows that stay in place take no other layout than partitions")
    writer = _writer(
        df, partition_by, max_files, cluster_by, sort_by, keep_partition_columns, mode, range_by,
        in_place=in_place,
    )
    blooms = {f"parquet.bloom.filter.enabled#{name}": "true" for name in cluster_by}
    writer.options(**blooms).parquet(path)


def write_json(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
    keep_partition_columns: bool = False,
    mode: str = "overwrite",
    compression: str | None = None,
) -> None:
    """JSON lines, with the same layout options.

    Compressed files (``gzip``) cannot be split, so they hold a bounded number of rows.
    """
    _writer(
        df, partition_by, max_files, (), (), keep_partition_columns, mode, compression=compression
    ).json(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    max_files: int | None = None,
    mode: str = "overwrite",
    compression: str | None = None,
) -> None:
    """CSV with a header, every field quoted and inner quotes doubled."""
    chosen = df.select(*columns) if columns else df
    writer = _writer(chosen, (), max_files, (), (), False, mode, compression=compression)
    writer.options(header=True, quoteAll=True, quote='"', escape='"').csv(path)
