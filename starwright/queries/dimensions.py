"""Dimension builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.operators.dimensions import (
    dimension_with_id,
    distinct_dimension,
    latest_per_key,
    ranked_per_key,
    surrogate_key,
    time_dimension,
    with_keys,
)
from starwright.operators.merges import keyed_last_write, merged_rows, rows_to_insert
from starwright.queries.registry import Tables, query

TIME_PARTS = """CAST(extract(hour FROM {ts}) AS INT) AS hour,
    CAST(extract(day FROM {ts}) AS INT) AS day, CAST(extract(week FROM {ts}) AS INT) AS week,
    CAST(extract(month FROM {ts}) AS INT) AS month, CAST(extract(year FROM {ts}) AS INT) AS year"""


@query("SELECT DISTINCT p_brand, p_type, p_size FROM part")
def songs_dim_distinct(t: Tables) -> DataFrame:
    return distinct_dimension(t.part, ["p_brand", "p_type", "p_size"])


@query(
    """SELECT user_id, event_type AS level, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
    FROM events WHERE user_id IS NOT NULL) t WHERE rn = 1"""
)
def users_dim_latest_all(t: Tables) -> DataFrame:
    columns = {"user_id": "user_id", "event_type": "level", "value": "value"}
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"], columns)


@query(
    """SELECT user_id, props, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
    FROM events WHERE event_type = 'view') t WHERE rn = 1"""
)
def users_dim_latest_filtered(t: Tables) -> DataFrame:
    views = t.events.filter(F.col("event_type") == "view")
    return latest_per_key(
        views, ["user_id"], ["ts", "event_id"], ["user_id", "props", "value"]
    )


@query(
    "SELECT DISTINCT user_id, event_type AS level FROM events WHERE event_type IN ('view', 'click')"
)
def users_dim_distinct_versions(t: Tables) -> DataFrame:
    seen = t.events.filter(F.col("event_type").isin("view", "click"))
    return distinct_dimension(seen, {"user_id": "user_id", "event_type": "level"})


@query(
    """SELECT f.user_id, f.props AS first_props, l.event_type AS level FROM
    (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
      FROM events) a WHERE rn = 1) f
    JOIN (SELECT * FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) b WHERE rn = 1) l
    ON f.user_id = l.user_id"""
)
def users_dim_upsert(t: Tables) -> DataFrame:
    rows = t.events.select(
        "user_id", F.col("props").alias("first_props"), F.col("event_type").alias("level"), "event_id"
    )
    columns = ["user_id", "first_props", "level"]
    return merged_rows(None, rows, ["user_id"], ["event_id"], columns, ["level"])


@query(
    """SELECT p_brand, p_partkey, p_name, p_retailprice FROM (SELECT *, row_number() OVER
    (PARTITION BY p_brand ORDER BY p_size ASC NULLS LAST, p_retailprice DESC NULLS FIRST, p_partkey)
    AS rn FROM part) t WHERE rn = 1"""
)
def artists_dim_ranked(t: Tables) -> DataFrame:
    order = [
        F.col("p_size").asc_nulls_last(),
        F.col("p_retailprice").desc_nulls_first(),
        F.col("p_partkey").asc(),
    ]
    columns = ["p_brand", "p_partkey", "p_name", "p_retailprice"]
    return ranked_per_key(t.part, ["p_brand"], order, columns)


@query(
    """SELECT p_brand, p_type, p_partkey, p_name FROM (SELECT *, row_number() OVER
    (PARTITION BY p_brand, p_type ORDER BY CASE WHEN p_size <= 25 THEN 0 ELSE 1 END, p_partkey)
    AS rn FROM part) t WHERE rn = 1"""
)
def artists_dim_do_nothing(t: Tables) -> DataFrame:
    """Two batches: parts up to size 25, then all; what is there already stays."""
    keys, columns = ["p_brand", "p_type"], ["p_brand", "p_type", "p_partkey", "p_name"]
    first_batch = t.part.filter(F.col("p_size") <= 25)
    loaded = rows_to_insert(None, first_batch, keys, ["p_partkey"], columns)
    added = rows_to_insert(loaded, t.part, keys, ["p_partkey"], columns)
    return loaded.unionByName(added)


@query(
    f"""SELECT DISTINCT ts AS start_time, {TIME_PARTS.format(ts="ts")},
    CAST(extract(dayofweek FROM ts) + 1 AS INT) AS weekday FROM events WHERE event_type = 'view'"""
)
def time_dim_weekday_one_based(t: Tables) -> DataFrame:
    views = t.events.filter(F.col("event_type") == "view")
    return time_dimension(views, "ts", weekday_encoding="one")


@query(
    f"""SELECT o_orderdate AS start_time, {TIME_PARTS.format(ts="o_orderdate")},
    CAST(extract(dayofweek FROM o_orderdate) AS INT) AS weekday FROM orders"""
)
def time_dim_weekday_zero_based(t: Tables) -> DataFrame:
    return time_dimension(t.orders, "o_orderdate", weekday_encoding="zero", dedupe=False)


@query(
    f"""SELECT DISTINCT o_orderdate AS start_time, {TIME_PARTS.format(ts="o_orderdate")},
    dayname(o_orderdate) AS weekday FROM orders"""
)
def time_dim_weekday_name(t: Tables) -> DataFrame:
    return time_dimension(t.orders, "o_orderdate", weekday_encoding="name")


@query(
    """SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS type_id
    FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL) t"""
)
def surrogate_key_dim(t: Tables) -> DataFrame:
    return dimension_with_id(t.events, "event_type", "type_id")


@query(
    """SELECT ts, CAST(row_number() OVER (ORDER BY ts) AS BIGINT) AS ts_id
    FROM (SELECT DISTINCT ts FROM events WHERE ts IS NOT NULL) t"""
)
def surrogate_key_large(t: Tables) -> DataFrame:
    """A dimension as large as the table: ids still need no single-task sort."""
    stamps = with_keys(t.events.select("ts"), ["ts"]).distinct()
    return surrogate_key(stamps, ["ts"], "ts_id")


@query(
    """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER
    (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS rn FROM events) t WHERE rn = 1"""
)
def keyed_last_write_wins(t: Tables) -> DataFrame:
    return keyed_last_write(
        t.events, ["event_type", "user_id"], ["event_id"], ["user_id", "event_type", "value"]
    )
