"""Query-first tables: one table per question, keyed by what the question asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.operators.merges import keyed_last_write
from starwright.schemas import ACTIVITY_CSV, ACTIVITY_CSV_KEPT
from starwright.sinks.files import write_csv, write_parquet
from starwright.sources.files import LOAD_ORDER, read_csv
from starwright.storage import intermediates, written


def with_artist(log: DataFrame) -> DataFrame:
    """Rows with an artist; a CSV read gives null where a field is empty."""
    return log.filter(F.col("artist").isNotNull() & (F.col("artist") != ""))


def typed(rows: DataFrame) -> DataFrame:
    """The kept columns under their table names and types; lengths are 32-bit floats."""
    return rows.select(
        F.col("sessionId").cast("int").alias("session_id"),
        F.col("itemInSession").cast("int").alias("item_in_session"),
        F.col("userId").cast("int").alias("user_id"),
        "artist",
        F.col("length").cast("float").alias("length"),
        "song",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        LOAD_ORDER,
    )


# Table name -> (partition key, clustering key, other columns).
TABLES = {
    "songs": (["session_id"], ["item_in_session"], ["artist", "length", "song"]),
    "user_activity": (
        ["user_id", "session_id"],
        ["item_in_session"],
        ["artist", "first_name", "last_name", "song"],
    ),
    "user_list": (["song"], ["user_id"], ["first_name", "last_name"]),
}


def build(spark: SparkSession, csv_path: str, output: str) -> dict[str, DataFrame]:
    """Concatenate the CSV files, keep rows with an artist, write the three tables.

    Each table holds one row per key, the last one loaded; it is clustered by
    its partition key and sorted by its clustering key. The load order is that of
    the source files; the concatenated CSV goes out beside the tables.
    """
    tables = {}
    with intermediates(spark):
        log = with_artist(read_csv(spark, csv_path, ACTIVITY_CSV, with_load_order=True))
        kept = written(log.select(*ACTIVITY_CSV_KEPT, LOAD_ORDER), "events")
        write_csv(kept, f"{output}/events_csv", columns=ACTIVITY_CSV_KEPT, compression="gzip")
        rows = typed(kept)
        for name, (partition_key, clustering_key, columns) in TABLES.items():
            key = [*partition_key, *clustering_key]
            table = keyed_last_write(rows, key, [LOAD_ORDER], [*key, *columns])
            write_parquet(table, f"{output}/{name}", cluster_by=partition_key, sort_by=clustering_key)
            tables[name] = spark.read.schema(table.schema).parquet(f"{output}/{name}")
    return tables


def song_at(songs: DataFrame, session_id: int, item_in_session: int) -> DataFrame:
    """The song heard at a place in a session."""
    here = (F.col("session_id") == session_id) & (F.col("item_in_session") == item_in_session)
    return songs.filter(here).select("artist", "length", "song")


def session_of_user(user_activity: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What a user heard in a session, in order."""
    here = (F.col("user_id") == user_id) & (F.col("session_id") == session_id)
    heard = user_activity.filter(here).orderBy(F.col("item_in_session").asc_nulls_last())
    return heard.select("artist", "song", "first_name", "last_name")


def listeners(user_list: DataFrame, song: str) -> DataFrame:
    """Users who heard a song."""
    return user_list.filter(F.col("song") == song).select("first_name", "last_name")
