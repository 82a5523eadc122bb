"""The music star builds on activity and catalog data derived from the test tables.

Order lines stand for plays (returned ones for other pages), parts for songs,
brands for artists and suppliers for users. Part of the catalog carries other
lengths than the plays, so that some plays match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.dimensions import pick
from starwright.operators.matching import match_inner
from starwright.operators.merges import keyed_last_write, merged_rows
from starwright.operators.quality import id_counts
from starwright.plans import incremental, lake, lookups, upserts, warehouse
from starwright.queries.registry import REGISTRY, Tables, query
from starwright.schemas import (
    ACTIVITY_CSV,
    INCREMENTAL_EVENTS,
    INCREMENTAL_SONGS,
    SONG,
    WAREHOUSE_EVENTS,
    WAREHOUSE_SONGS,
)
from starwright.sinks.files import ROWS_PER_TEXT_FILE, write_json, write_parquet
from starwright.sinks.tables import SERIAL_TASKS, create_database
from starwright.sources.files import LOAD_ORDER
from starwright.sources.staging import coerce_to_schema, map_fields
from starwright.storage import scratch_dir, written

#: Buckets of the builds' merge targets: what small tables need.
FEW = 4
JANUARY_2024_MS = 1704067200000  # 2024-01-01 00:00:00 UTC

LOG_SQL = f"""log AS (SELECT p_brand AS artist,
    CASE WHEN s_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 'Supplier' AS "firstName",
    CAST(l_linenumber AS BIGINT) AS "itemInSession", s_name AS "lastName", p_retailprice AS length,
    CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'free' END AS level,
    'Nation ' || CAST(s_nationkey AS VARCHAR) AS location,
    CASE WHEN l_returnflag = 'R' THEN 'Home' ELSE 'NextSong' END AS page,
    l_orderkey AS "sessionId", p_name AS song,
    {JANUARY_2024_MS} + ((l_orderkey * 7919 + l_linenumber * 104729 + l_suppkey * 31) % 2678400)
      * 1000 + l_partkey % 1000 AS ts,
    'agent "' || l_returnflag || '"' AS "userAgent", l_suppkey AS "userId"
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

CATALOG_SQL = """catalog AS (SELECT 'A' || p_brand AS artist_id,
    CASE WHEN p_size % 4 <> 0 THEN p_size * 1.5 END AS artist_latitude,
    p_size * -2.25 AS artist_longitude, p_type AS artist_location, p_brand AS artist_name,
    'S' || CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title,
    CASE WHEN p_size > 25 THEN p_retailprice + 2000 ELSE p_retailprice END AS duration,
    CAST(1970 + p_size AS BIGINT) AS year FROM part)"""

STAMPS_SQL = "make_timestamp(ts * 1000)"
SECONDS_SQL = "make_timestamp(ts // 1000 * 1000000)"
PLAYS_SQL = f"""plays AS (SELECT *, {STAMPS_SQL} AS start_time FROM log WHERE page = 'NextSong')"""
MATCH_SQL = "artist = artist_name AND song = title AND length = duration"
WHOLE_MATCH_SQL = "artist = artist_name AND song = title AND trunc(length) = trunc(duration)"
PARTS_SQL = """CAST(extract(hour FROM start_time) AS {n}) AS hour,
    CAST(extract(day FROM start_time) AS {n}) AS day, CAST(extract(week FROM start_time) AS {n}) AS week,
    CAST(extract(month FROM start_time) AS {n}) AS month,
    CAST(extract(year FROM start_time) AS {n}) AS year"""


def _lines(t: Tables) -> DataFrame:
    """What the log's columns derive from."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    named = {"p_brand": "artist", "p_name": "song", "p_retailprice": "length"}
    lines = match_inner(lines, t.part, {"l_partkey": "p_partkey"}, named)
    lines = match_inner(
        lines, t.supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "lastName", "s_nationkey": "nation"}
    )
    second = F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_suppkey") * 31
    ms = F.lit(JANUARY_2024_MS) + (second % 2678400) * 1000 + F.col("l_partkey") % 1000
    return lines.select(
        "artist",
        F.col("l_linenumber").cast("long").alias("itemInSession"),
        "lastName",
        "length",
        F.when(F.col("l_linestatus") == "F", "paid").otherwise("free").alias("level"),
        "nation",
        F.col("l_returnflag").alias("flag"),
        F.col("l_orderkey").alias("sessionId"),
        "song",
        ms.alias("ts"),
        F.col("l_suppkey").cast("string").alias("userId"),
    )


def _as_log(lines: DataFrame) -> DataFrame:
    return lines.select(
        "artist",
        F.lit("Logged In").alias("auth"),
        F.lit("Supplier").alias("firstName"),
        F.when(F.col("nation") % 2 == 0, "F").otherwise("M").alias("gender"),
        "itemInSession",
        "lastName",
        "length",
        "level",
        F.concat(F.lit("Nation "), F.col("nation").cast("string")).alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("flag") == "R", "Home").otherwise("NextSong").alias("page"),
        F.lit(1.54e12).alias("registration"),
        "sessionId",
        "song",
        F.lit(200).cast("long").alias("status"),
        "ts",
        F.concat(F.lit('agent "'), F.col("flag"), F.lit('"')).alias("userAgent"),
        "userId",
    )


def _log(t: Tables) -> DataFrame:
    return _as_log(_lines(t))


def _catalog(t: Tables) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    return t.part.select(
        F.lit(1).cast("long").alias("num_songs"),
        F.concat(F.lit("A"), F.col("p_brand")).alias("artist_id"),
        F.when(size % 4 != 0, size * 1.5).alias("artist_latitude"),
        (size * -2.25).alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.when(size > 25, price + 2000).otherwise(price).alias("duration"),
        (size + 1970).cast("long").alias("year"),
    )


LOG_ORDER = ["ts", "sessionId", "itemInSession", "userId", "song", "length", "level", "userAgent"]


#: The same order of what the log derives from: agents are named by flags.
LINE_ORDER = [*LOG_ORDER[:-1], "flag"]


def _in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


@contextmanager
def _sources(t: Tables) -> Iterator[tuple[str, str]]:
    """Both as compressed JSON files; the log in the order of time, so that load order is defined."""

    def write(root: str) -> None:
        write_json(_in_order(_catalog(t), ["song_id"]), f"{root}/songs", compression="gzip")
        log = _as_log(_in_order(_lines(t), LINE_ORDER))
        write_json(log, f"{root}/log/2024", compression="gzip")

    with t.source_files("music-sources", write) as root:
        yield f"{root}/songs", f"{root}/log"


def _database(t: Tables) -> str:
    location = scratch_dir(t.spark, "db")
    return create_database(t.spark, "starwright_" + location[-12:], location)


def _as_plain(df: DataFrame, **casts: str) -> DataFrame:
    """Whole-number decimals as integers, timestamps without zone, for comparison."""
    plain = {}
    for name, kind in df.dtypes:
        if kind == "decimal(18,0)":
            plain[name] = F.col(name).cast("long")
        elif kind == "timestamp":
            plain[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(plain | {name: F.col(name).cast(kind) for name, kind in casts.items()})


# --- lake ---------------------------------------------------------------------------


@query(f"WITH {CATALOG_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM catalog")
def lake_songs(t: Tables) -> DataFrame:
    return lake.songs(_catalog(t))


@query(
    f"""WITH {CATALOG_SQL} SELECT DISTINCT artist_id, artist_name, artist_location,
    CAST(artist_latitude AS DOUBLE) AS artist_latitude,
    CAST(artist_longitude AS DOUBLE) AS artist_longitude FROM catalog"""
)
def lake_artists(t: Tables) -> DataFrame:
    return lake.artists(_catalog(t))


@query(
    f"""WITH {LOG_SQL} SELECT CAST("userId" AS VARCHAR) AS "userId", "firstName", "lastName", gender,
    level FROM (SELECT *, row_number() OVER
      (PARTITION BY "userId" ORDER BY ts DESC, level DESC, "sessionId" DESC) AS rn
      FROM log WHERE page = 'NextSong') t WHERE rn = 1"""
)
def lake_users(t: Tables) -> DataFrame:
    return lake.users(lake.plays(_log(t)))


@query(
    f"""WITH {LOG_SQL}, {PLAYS_SQL} SELECT DISTINCT start_time, {PARTS_SQL.format(n="INT")},
    CAST(extract(dayofweek FROM start_time) + 1 AS INT) AS weekday FROM plays"""
)
def lake_time(t: Tables) -> DataFrame:
    return _as_plain(lake.time(lake.plays(_log(t))))


LAKE_SONGPLAYS_SQL = f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL} SELECT start_time AS timestamp,
    CAST("userId" AS VARCHAR) AS "userId", level, song_id, artist_id, "sessionId", location,
    "userAgent", CAST(extract(year FROM start_time) AS INT) AS year,
    CAST(extract(month FROM start_time) AS INT) AS month FROM plays JOIN catalog ON {MATCH_SQL}"""


@query(LAKE_SONGPLAYS_SQL)
def lake_songplays(t: Tables) -> DataFrame:
    return _as_plain(lake.songplays(lake.plays(_log(t)), _catalog(t)))


@query(LAKE_SONGPLAYS_SQL)
def lake_star_files(t: Tables) -> DataFrame:
    """The whole build from JSON to partitioned parquet; the fact read back."""
    return _as_plain(_lake(t)["songplays"])


# --- warehouse ----------------------------------------------------------------------


def _warehouse_staging(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = coerce_to_schema(map_fields(_log(t), warehouse.EVENT_FIELDS), WAREHOUSE_EVENTS)
    return events, coerce_to_schema(_catalog(t), WAREHOUSE_SONGS)


@query(
    f"""WITH {LOG_SQL} SELECT "userId" AS user_id, "firstName" AS first_name,
    "lastName" AS last_name, gender, level FROM (SELECT *, row_number() OVER
      (PARTITION BY "userId" ORDER BY ts DESC, level DESC, "sessionId" DESC) AS rn FROM log
      WHERE "userId" IS NOT NULL) t WHERE rn = 1"""
)
def warehouse_users(t: Tables) -> DataFrame:
    return _as_plain(warehouse.users(_warehouse_staging(t)[0]))


@query(
    f"""WITH {CATALOG_SQL} SELECT DISTINCT song_id, title, artist_id, year,
    CAST(trunc(duration) AS BIGINT) AS duration FROM catalog"""
)
def warehouse_songs(t: Tables) -> DataFrame:
    return _as_plain(warehouse.songs(_warehouse_staging(t)[1]))


@query(
    f"""WITH {CATALOG_SQL}, staged AS (SELECT artist_id, artist_name AS name,
      artist_location AS location, CAST(trunc(artist_latitude) AS BIGINT) AS latitude,
      CAST(trunc(artist_longitude) AS BIGINT) AS longitude FROM catalog)
    SELECT artist_id, name, location, latitude, longitude FROM (SELECT *, row_number() OVER
      (PARTITION BY artist_id ORDER BY latitude ASC NULLS LAST, longitude DESC NULLS FIRST,
        name, location) AS rn FROM staged WHERE artist_id IS NOT NULL) t WHERE rn = 1"""
)
def warehouse_artists(t: Tables) -> DataFrame:
    return _as_plain(warehouse.artists(_warehouse_staging(t)[1]))


WAREHOUSE_SONGPLAYS_SQL = f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL} SELECT start_time,
    "userId" AS user_id, level, song_id, artist_id, CAST("sessionId" AS VARCHAR) AS session_id,
    location, "userAgent" AS user_agent FROM plays JOIN catalog ON {WHOLE_MATCH_SQL}"""


@query(WAREHOUSE_SONGPLAYS_SQL)
def warehouse_songplays(t: Tables) -> DataFrame:
    return _as_plain(warehouse.songplays(*_warehouse_staging(t)), session_id="string")


@query(
    f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL} SELECT start_time, {PARTS_SQL.format(n="INT")},
    CAST(extract(dayofweek FROM start_time) AS INT) AS weekday
    FROM plays JOIN catalog ON {WHOLE_MATCH_SQL}"""
)
def warehouse_time(t: Tables) -> DataFrame:
    return _as_plain(warehouse.time(warehouse.songplays(*_warehouse_staging(t))))


@query(WAREHOUSE_SONGPLAYS_SQL)
def warehouse_star_tables(t: Tables) -> DataFrame:
    """The whole build through staging tables; the fact read back without its serial id."""
    return _as_plain(_warehouse(t)["songplays"].drop("songplay_id"))


# --- upserts ------------------------------------------------------------------------

FILE_ORDER_SQL = """ts, "sessionId", "itemInSession", "userId", song, length, level, "userAgent" """
LOOKUP_SQL = f"""lookup AS (SELECT title, name, duration, min(song_id) AS song_id,
      arg_min(artist_id, song_id) AS artist_id FROM
      (SELECT s.*, a.name FROM catalog s JOIN (SELECT artist_id, min(artist_name) AS name FROM catalog
        GROUP BY artist_id) a ON s.artist_id = a.artist_id) c
      GROUP BY title, name, duration)"""
UPSERT_SONGPLAYS_SQL = f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL}, {LOOKUP_SQL}
    SELECT start_time, "userId" AS user_id, level, song_id, artist_id, "sessionId" AS session_id,
    location, "userAgent" AS user_agent FROM plays
    LEFT JOIN lookup ON song = title AND artist = name AND length = duration"""


@query(UPSERT_SONGPLAYS_SQL)
def upsert_songplays(t: Tables) -> DataFrame:
    plays = lake.plays(_log(t)).withColumnRenamed("timestamp", "start_time")
    songs = _catalog(t).select("song_id", "title", "artist_id", "year", "duration")
    artists = _catalog(t).select("artist_id", F.col("artist_name").alias("name")).distinct()
    facts = upserts.songplays(plays, upserts.song_lookup(songs, artists))
    names = {"userId": "user_id", "sessionId": "session_id", "userAgent": "user_agent"}
    return _as_plain(facts.withColumnsRenamed(names), user_id="long")


UPSERT_USERS_SQL = f"""WITH {LOG_SQL}, ranked AS (SELECT *,
      row_number() OVER (PARTITION BY "userId" ORDER BY {FILE_ORDER_SQL}) AS first_rank,
      count(*) OVER (PARTITION BY "userId") AS n FROM log WHERE page = 'NextSong')
    SELECT f."userId" AS user_id, f."firstName" AS first_name, f."lastName" AS last_name, f.gender,
    l.level FROM (SELECT * FROM ranked WHERE first_rank = 1) f
    JOIN (SELECT * FROM ranked WHERE first_rank = n) l ON f."userId" = l."userId" """


@query(UPSERT_USERS_SQL)
def upsert_users(t: Tables) -> DataFrame:
    plays = _log(t).filter(F.col("page") == "NextSong").select(
        F.col("userId").cast("long").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        F.struct(*LOG_ORDER).alias("position"),
    )
    columns = ["user_id", "first_name", "last_name", "gender", "level"]
    return merged_rows(None, plays, ["user_id"], ["position"], columns, ["level"])


@query(
    f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL} SELECT 'songplays' AS table_name,
      2 * count(*) AS n_rows, 2 * count(*) AS n_keys FROM plays
    UNION ALL SELECT 'users', count(DISTINCT "userId"), count(DISTINCT "userId") FROM plays
    UNION ALL SELECT 'songs', count(DISTINCT song_id), count(DISTINCT song_id) FROM catalog
    UNION ALL SELECT 'artists', count(DISTINCT artist_id), count(DISTINCT artist_id) FROM catalog
    UNION ALL SELECT 'time', count(DISTINCT start_time), count(DISTINCT start_time) FROM plays"""
)
def upsert_star_twice(t: Tables) -> DataFrame:
    """The same batch merged twice: keyed tables stay, the fact doubles under new ids."""
    database = _database(t)
    with _sources(t) as sources:
        upserts.build(t.spark, database, *sources, buckets=FEW)
        tables = upserts.build(t.spark, database, *sources, buckets=FEW)
    keys = {
        "songplays": "songplay_id", "users": "user_id", "songs": "song_id",
        "artists": "artist_id", "time": "start_time",
    }
    counts = (
        tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(key).alias("n_keys"),
        )
        for name, key in keys.items()
    )
    return reduce(DataFrame.unionByName, counts)


@query(UPSERT_USERS_SQL)
def upsert_star_users(t: Tables) -> DataFrame:
    """Users after a merge in the load order of many files."""
    return _as_plain(_upserts(t)["users"], user_id="long")


# --- intervals ----------------------------------------------------------------------

INTERVAL_FACTS_SQL = f"""WITH {LOG_SQL}, {CATALOG_SQL}, timed AS (SELECT *,
      {SECONDS_SQL} AS start_time FROM log WHERE page = 'NextSong'),
    facts AS (SELECT md5(CAST("sessionId" AS VARCHAR) || CAST(start_time AS VARCHAR)) AS playid,
      start_time, "userId" AS userid, level, song_id AS songid, artist_id AS artistid,
      "sessionId" AS sessionid, location, "userAgent" AS user_agent
      FROM timed LEFT JOIN catalog ON {WHOLE_MATCH_SQL}
      WHERE CAST(start_time AS DATE) > DATE '2024-01-01'
      AND CAST(start_time AS DATE) <= DATE '2024-02-01')"""


def _interval_staging(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = coerce_to_schema(map_fields(_log(t), incremental.EVENT_FIELDS), INCREMENTAL_EVENTS)
    return events, coerce_to_schema(_catalog(t), INCREMENTAL_SONGS)


@query(
    f"""WITH {LOG_SQL} SELECT DISTINCT "userId" AS userid, "firstName" AS firstname,
    "lastName" AS lastname, gender, level FROM log WHERE page = 'NextSong'"""
)
def interval_users(t: Tables) -> DataFrame:
    return _as_plain(incremental.users(_interval_staging(t)[0]), userid="long")


@query(
    f"""WITH {CATALOG_SQL} SELECT DISTINCT artist_id, artist_name, artist_location,
    CAST(trunc(artist_latitude) AS BIGINT) AS artist_latitude,
    CAST(trunc(artist_longitude) AS BIGINT) AS artist_longitude FROM catalog"""
)
def interval_artists(t: Tables) -> DataFrame:
    return _as_plain(incremental.artists(_interval_staging(t)[1]))


def _interval_runs(t: Tables) -> dict[str, DataFrame]:
    """The runs of mid-January and of February's start, the second one twice."""
    database = _database(t)
    with _sources(t) as sources:
        for execution in (date(2024, 1, 15), date(2024, 2, 1), date(2024, 2, 1)):
            tables = incremental.run(
                t.spark, database, *sources, execution, repeatable=True, buckets=FEW
            )
    return tables


@query(f"{INTERVAL_FACTS_SQL} SELECT * FROM facts")
def interval_star_facts(t: Tables) -> DataFrame:
    facts = _interval_runs(t)["songplays"].drop("load_until")
    return _as_plain(facts, userid="long", sessionid="long")


@query(
    f"""{INTERVAL_FACTS_SQL} SELECT start_time, CAST(extract(hour FROM start_time) AS INT) AS hour,
    CAST(extract(day FROM start_time) AS INT) AS day,
    CAST(extract(week FROM start_time) AS INT) AS week,
    CAST(extract(month FROM start_time) AS VARCHAR) AS month,
    CAST(extract(year FROM start_time) AS INT) AS year,
    CAST(extract(dayofweek FROM start_time) AS VARCHAR) AS weekday FROM facts"""
)
def interval_star_time(t: Tables) -> DataFrame:
    """The time dimension of one append run per interval, its month and weekday as text."""
    database = _database(t)
    with _sources(t) as sources:
        for execution in (date(2024, 1, 15), date(2024, 2, 1)):
            tables = incremental.run(t.spark, database, *sources, execution, buckets=FEW)
    return _as_plain(tables["time"])


# --- query-first tables -------------------------------------------------------------


def _last_per_key_sql(key: str, columns: str) -> str:
    """Last row per key in the order the CSV files hold."""
    order = ", ".join(f"{name.strip()} DESC" for name in FILE_ORDER_SQL.split(","))
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER
      (PARTITION BY {key} ORDER BY {order}) AS rn FROM log) t WHERE rn = 1"""


ACTIVITY_COLUMNS_SQL = """CAST("userId" AS INT) AS user_id, CAST("sessionId" AS INT) AS session_id,
    CAST("itemInSession" AS INT) AS item_in_session, artist, "firstName" AS first_name,
    "lastName" AS last_name, song"""


def _csv(t: Tables) -> AbstractContextManager[str]:
    """The log as compressed CSV files in the order of time."""

    def write(path: str) -> None:
        lines = _lines(t).withColumn("userId", F.col("userId").cast("long"))
        texts = _as_log(_in_order(lines, LINE_ORDER)).select(*ACTIVITY_CSV.names)
        options = {"header": True, "quote": '"', "escape": '"', "compression": "gzip"}
        texts.write.options(**options, maxRecordsPerFile=ROWS_PER_TEXT_FILE).csv(path)

    return t.source_files("activity-csv", write)


@query(
    f"""WITH {LOG_SQL} {_last_per_key_sql('"userId", "sessionId", "itemInSession"',
    ACTIVITY_COLUMNS_SQL)}"""
)
def lookup_tables_from_csv(t: Tables) -> DataFrame:
    """The whole build from CSV; the largest table read back."""
    return _lookups(t)["user_activity"]


@query(
    f"""WITH {LOG_SQL} {_last_per_key_sql('"sessionId", "itemInSession"',
    '''CAST("sessionId" AS INT) AS session_id, CAST("itemInSession" AS INT) AS item_in_session,
    artist, CAST(CAST(length AS FLOAT) AS DOUBLE) AS length, song''')}"""
)
def lookup_table_of_songs(t: Tables) -> DataFrame:
    songs = _lookups(t)["songs"]
    return songs.withColumn("length", F.col("length").cast("double"))


@query(
    f"""WITH {LOG_SQL}, activity AS ({_last_per_key_sql('"userId", "sessionId", "itemInSession"',
    ACTIVITY_COLUMNS_SQL)}) SELECT artist, song, first_name, last_name FROM activity
    WHERE user_id = (SELECT min(user_id) FROM activity WHERE session_id = 100) AND session_id = 100"""
)
def lookup_session_of_user(t: Tables) -> DataFrame:
    """What the first user of a session heard there, in order."""
    rows = _log(t).select(
        F.col("userId").cast("int").alias("user_id"),
        F.col("sessionId").cast("int").alias("session_id"),
        F.col("itemInSession").cast("int").alias("item_in_session"),
        "artist",
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "song",
        F.struct("ts", "song", "length", "level", "userAgent").alias(LOAD_ORDER),
    )
    key = ["user_id", "session_id", "item_in_session"]
    names = [*key, "artist", "first_name", "last_name", "song"]
    activity = written(keyed_last_write(rows, key, [LOAD_ORDER], names), "activity")
    user = activity.filter(F.col("session_id") == 100).agg(F.min("user_id")).first()[0]
    return lookups.session_of_user(activity, user, 100)


@query(
    f"""WITH {LOG_SQL} SELECT DISTINCT "firstName" AS first_name, "lastName" AS last_name
    FROM log WHERE song = 'red widget'"""
)
def lookup_listeners(t: Tables) -> DataFrame:
    users = _log(t).select(
        "song", F.col("userId").cast("int").alias("user_id"),
        F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name"), "ts",
    )
    table = keyed_last_write(
        users, ["song", "user_id"], ["ts"], ["song", "user_id", "first_name", "last_name"]
    )
    return lookups.listeners(table, "red widget")


# --- every table of the builds, read back from what they wrote ------------------------


def _sql_of(name: str) -> str:
    return REGISTRY[name].sql


def _lake(t: Tables) -> dict[str, DataFrame]:
    with _sources(t) as sources:
        return lake.build(t.spark, *sources, scratch_dir(t.spark, "lake"))


def _warehouse(t: Tables) -> dict[str, DataFrame]:
    with _sources(t) as sources:
        return warehouse.build(t.spark, _database(t), *sources)


def _upserts(t: Tables) -> dict[str, DataFrame]:
    with _sources(t) as sources:
        return upserts.build(t.spark, _database(t), *sources, buckets=FEW)


def _lookups(t: Tables) -> dict[str, DataFrame]:
    with _csv(t) as path:
        return lookups.build(t.spark, path, scratch_dir(t.spark, "lookups"))


@query(_sql_of("lake_songs"))
def lake_star_songs(t: Tables) -> DataFrame:
    return _lake(t)["songs"]


@query(_sql_of("lake_songs"))
def lake_songs_by_artist(t: Tables) -> DataFrame:
    """The layout with a directory for each year and artist, read back."""
    songs, path = lake.songs(_catalog(t)), scratch_dir(t.spark, "songs-by-artist")
    write_parquet(songs, path, partition_by=["year", "artist_id"])
    return t.spark.read.schema(songs.schema).parquet(path)


@query(_sql_of("lake_artists"))
def lake_star_artists(t: Tables) -> DataFrame:
    return _lake(t)["artists"]


@query(_sql_of("lake_users"))
def lake_star_users(t: Tables) -> DataFrame:
    return _lake(t)["users"]


@query(_sql_of("lake_time"))
def lake_star_time(t: Tables) -> DataFrame:
    return _as_plain(_lake(t)["time"])


@query(_sql_of("warehouse_users"))
def warehouse_star_users(t: Tables) -> DataFrame:
    return _as_plain(_warehouse(t)["users"])


@query(_sql_of("warehouse_songs"))
def warehouse_star_songs(t: Tables) -> DataFrame:
    return _as_plain(_warehouse(t)["songs"])


@query(_sql_of("warehouse_artists"))
def warehouse_star_artists(t: Tables) -> DataFrame:
    return _as_plain(_warehouse(t)["artists"])


@query(_sql_of("warehouse_time"))
def warehouse_star_time(t: Tables) -> DataFrame:
    parts = dict.fromkeys(["hour", "day", "week", "month", "year", "weekday"], "int")
    return _as_plain(_warehouse(t)["time"], **parts)


@query(
    f"""WITH {LOG_SQL}, {CATALOG_SQL}, {PLAYS_SQL} SELECT count(*) AS n_rows, count(*) AS n_ids
    FROM plays JOIN catalog ON {WHOLE_MATCH_SQL}"""
)
def warehouse_star_serials(t: Tables) -> DataFrame:
    """How many plays the build's fact has, and under how many ids."""
    return id_counts(_warehouse(t)["songplays"], "songplay_id", SERIAL_TASKS)


@query(
    f"""WITH {CATALOG_SQL} SELECT song_id, title, artist_id, CAST(year AS INT) AS year, duration
    FROM catalog"""
)
def upsert_star_songs(t: Tables) -> DataFrame:
    return _upserts(t)["songs"]


@query(
    f"""WITH {CATALOG_SQL} SELECT artist_id, artist_name AS name, artist_location AS location,
    CAST(artist_latitude AS DOUBLE) AS latitude, CAST(artist_longitude AS DOUBLE) AS longitude
    FROM (SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS rn FROM catalog) c
    WHERE rn = 1"""
)
def upsert_star_artists(t: Tables) -> DataFrame:
    """Each artist as in the file that came first."""
    return _upserts(t)["artists"]


@query(
    f"""WITH {LOG_SQL}, {PLAYS_SQL} SELECT DISTINCT start_time, {PARTS_SQL.format(n="INT")},
    dayname(start_time) AS weekday FROM plays"""
)
def upsert_star_time(t: Tables) -> DataFrame:
    return _as_plain(_upserts(t)["time"])


@query(UPSERT_SONGPLAYS_SQL)
def upsert_star_songplays(t: Tables) -> DataFrame:
    facts = _upserts(t)["songplays"].drop("songplay_id")
    return _as_plain(facts, user_id="long", session_id="long")


@query(
    f"""WITH {CATALOG_SQL} SELECT DISTINCT song_id AS songid, title, artist_id AS artistid,
    CAST(year AS INT) AS year, CAST(trunc(duration) AS BIGINT) AS duration FROM catalog"""
)
def interval_star_songs(t: Tables) -> DataFrame:
    return _as_plain(_interval_runs(t)["songs"])


@query(
    f"""WITH {CATALOG_SQL} SELECT DISTINCT artist_id AS artistid, artist_name AS name,
    artist_location AS location, CAST(trunc(artist_latitude) AS BIGINT) AS latitude,
    CAST(trunc(artist_longitude) AS BIGINT) AS longitude FROM catalog"""
)
def interval_star_artists(t: Tables) -> DataFrame:
    return _as_plain(_interval_runs(t)["artists"])


@query(
    f"""WITH {LOG_SQL} SELECT DISTINCT "userId" AS userid, "firstName" AS first_name,
    "lastName" AS last_name, gender, level FROM log WHERE page = 'NextSong'"""
)
def interval_star_users(t: Tables) -> DataFrame:
    return _as_plain(_interval_runs(t)["users"], userid="long")


@query(
    f"""WITH {LOG_SQL} {_last_per_key_sql('song, "userId"', '''song, CAST("userId" AS INT) AS user_id,
    "firstName" AS first_name, "lastName" AS last_name''')}"""
)
def lookup_table_of_listeners(t: Tables) -> DataFrame:
    return _lookups(t)["user_list"]


@query(
    f"""WITH {LOG_SQL}, songs AS ({_last_per_key_sql('"sessionId", "itemInSession"',
    '"sessionId" AS session_id, "itemInSession" AS item_in_session, artist, length, song')})
    SELECT artist, CAST(CAST(length AS FLOAT) AS DOUBLE) AS length, song FROM songs
    WHERE session_id = 100 AND item_in_session = 1"""
)
def lookup_song_at(t: Tables) -> DataFrame:
    heard = lookups.song_at(_lookups(t)["songs"], 100, 1)
    return heard.withColumn("length", F.col("length").cast("double"))
