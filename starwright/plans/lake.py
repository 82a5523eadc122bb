"""Star schema as a lake of parquet files, partitioned for its readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.functions.timeparts import from_epoch_ms
from starwright.operators.dimensions import distinct_dimension, latest_per_key, time_dimension
from starwright.operators.matching import match_inner
from starwright.plans.music import SONG_MATCH, only_plays
from starwright.schemas import ACTIVITY_LOG, SONG
from starwright.sinks.files import write_parquet
from starwright.sources.files import read_json, small_files
from starwright.storage import intermediates, written


def songs(catalog: DataFrame) -> DataFrame:
    return distinct_dimension(catalog, ["song_id", "title", "artist_id", "year", "duration"])


def artists(catalog: DataFrame) -> DataFrame:
    return distinct_dimension(
        catalog,
        ["artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"],
    )


def plays(log: DataFrame) -> DataFrame:
    """Plays with their time as a timestamp, and the columns the tables need."""
    return only_plays(log).select(
        from_epoch_ms(F.col("ts")).alias("timestamp"), "userId", "firstName", "lastName",
        "gender", "level", "artist", "song", "length", "sessionId", "location", "userAgent",
    )


def users(played: DataFrame) -> DataFrame:
    """Each user as in their latest play; equal times fall back to the greater level."""
    return latest_per_key(
        played,
        ["userId"],
        ["timestamp", "level", "sessionId"],
        ["userId", "firstName", "lastName", "gender", "level"],
        drop_null_keys=False,
    )


def time(played: DataFrame) -> DataFrame:
    return time_dimension(played, "timestamp", weekday_encoding="one")


def songplays(played: DataFrame, catalog: DataFrame) -> DataFrame:
    """Plays of songs the catalog knows."""
    matched = match_inner(played, catalog, SONG_MATCH, ["song_id", "artist_id"], together=True)
    return matched.select(
        "timestamp", "userId", "level", "song_id", "artist_id", "sessionId", "location",
        "userAgent", F.year("timestamp").alias("year"), F.month("timestamp").alias("month"),
    )


def build(
    spark: SparkSession,
    songs_path: str,
    log_path: str,
    output: str,
    *,
    song_partitions: Sequence[str] = ("year",),
    small_table_files: int | None = None,
) -> dict[str, DataFrame]:
    """Read both JSON trees once, write the five tables, return them read back.

    The JSON is parsed once and kept as columns, of which each table then
    reads only its own. ``song_partitions`` may add "artist_id" for small
    catalogs: each artist is then a directory. ``small_table_files`` limits the
    files, and so the tasks, that write artists and users.
    """
    with intermediates(spark):
        with small_files(spark):  # one file for each song
            catalog = written(read_json(spark, songs_path, SONG, recursive=True), "catalog")
        played = written(plays(read_json(spark, log_path, ACTIVITY_LOG, recursive=True)), "plays")
        by_month = {"partition_by": ["year", "month"]}
        small = {"max_files": small_table_files}
        tables = {
            "songs": (songs(catalog), {"partition_by": song_partitions}),
            "artists": (artists(catalog), small),
            "users": (users(played), small),
            "time": (time(played), by_month),
            "songplays": (songplays(played, catalog), {**by_month, "in_place": True}),
        }
        for name, (table, layout) in tables.items():
            write_parquet(table, f"{output}/{name}", **layout)
    return {
        name: spark.read.schema(table.schema).parquet(f"{output}/{name}")
        for name, (table, _) in tables.items()
    }
