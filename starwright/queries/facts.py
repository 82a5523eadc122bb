"""Fact joins, keys and slices."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.functions.cleaning import truncate_toward_zero
from starwright.functions.keys import md5_key
from starwright.operators.dimensions import dimension_with_id
from starwright.operators.intervals import interval_slice, semimonthly_bounds
from starwright.operators.matching import (
    attach_dimension,
    lookup_first,
    match_inner,
    match_left,
)
from starwright.queries.registry import Tables, query

PLAYS_AND_CATALOG = """WITH plays AS (SELECT l_orderkey, l_linenumber, p_name AS song,
      p_brand AS artist, p_retailprice AS length FROM lineitem JOIN part ON l_partkey = p_partkey),
    catalog AS (SELECT * FROM part WHERE p_size <= 25)
    SELECT l_orderkey, l_linenumber, p_partkey AS song_id"""
ON_NATURAL_KEYS = "ON song = p_name AND artist = p_brand AND length = p_retailprice"
NATURAL_KEYS = {"song": "p_name", "artist": "p_brand", "length": "p_retailprice"}


def _plays(t: Tables) -> DataFrame:
    """Order lines under the natural keys of what they sold."""
    named = {"p_name": "song", "p_brand": "artist", "p_retailprice": "length"}
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return match_inner(lines, t.part, {"l_partkey": "p_partkey"}, named)


def _catalog(t: Tables) -> DataFrame:
    """The catalog knows only the smaller parts, so that some plays have no match."""
    return t.part.filter(F.col("p_size") <= 25)


@query(f"{PLAYS_AND_CATALOG} FROM plays JOIN catalog {ON_NATURAL_KEYS}")
def fact_inner_match(t: Tables) -> DataFrame:
    matched = match_inner(_plays(t), _catalog(t), NATURAL_KEYS, {"p_partkey": "song_id"})
    return matched.select("l_orderkey", "l_linenumber", "song_id")


@query(f"{PLAYS_AND_CATALOG} FROM plays LEFT JOIN catalog {ON_NATURAL_KEYS}")
def fact_left_match(t: Tables) -> DataFrame:
    matched = match_left(_plays(t), _catalog(t), NATURAL_KEYS, {"p_partkey": "song_id"})
    return matched.select("l_orderkey", "l_linenumber", "song_id")


@query(
    """WITH catalog AS (SELECT p_name, p_brand, min(p_partkey) AS song_id FROM part
      WHERE p_size <= 25 GROUP BY p_name, p_brand)
    SELECT l_orderkey, l_linenumber, l_partkey, c.song_id FROM lineitem
    JOIN part p ON l_partkey = p.p_partkey
    LEFT JOIN catalog c ON p.p_name = c.p_name AND p.p_brand = c.p_brand"""
)
def fact_lookup_first_match(t: Tables) -> DataFrame:
    """Two of the three keys only, so that several parts match a line."""
    catalog = _catalog(t).withColumn("song_id", F.col("p_partkey"))
    found = lookup_first(_plays(t), catalog, {"song": "p_name", "artist": "p_brand"}, ["song_id"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "song_id")


@query(
    """SELECT md5(CAST(user_id AS VARCHAR) || CAST(date_trunc('second', ts) AS VARCHAR)) AS play_id,
    event_id FROM events WHERE event_type = 'view'"""
)
def fact_md5_key(t: Tables) -> DataFrame:
    views = t.events.filter(F.col("event_type") == "view")
    second = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return views.select(md5_key(F.col("user_id"), second).alias("play_id"), "event_id")


@query(
    """SELECT l_orderkey, l_linenumber, o_orderkey FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    AND CAST(trunc(l_extendedprice / 1000) AS DECIMAL(18,0))
      = CAST(trunc(o_totalprice / 1000) AS DECIMAL(18,0))"""
)
def fact_numeric18_match(t: Tables) -> DataFrame:
    def thousands(name: str):
        return truncate_toward_zero(F.col(name) / 1000).alias("thousands")

    lines = t.lineitem.select("l_orderkey", "l_linenumber", thousands("l_extendedprice"))
    orders = t.orders.select("o_orderkey", thousands("o_totalprice"))
    on = {"l_orderkey": "o_orderkey", "thousands": "thousands"}
    return match_inner(lines, orders, on, ["o_orderkey"]).drop("thousands")


@query(
    """SELECT event_id, user_id, ts FROM events
    WHERE CAST(ts AS DATE) > DATE '2024-01-01' AND CAST(ts AS DATE) <= DATE '2024-01-15'"""
)
def fact_interval_slice(t: Tables) -> DataFrame:
    bounds = semimonthly_bounds(date(2024, 1, 15))
    return interval_slice(t.events, "ts", *bounds).select("event_id", "user_id", "ts")


@query(
    """WITH cat AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS category_id
      FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO') t),
    st AS (SELECT s_nationkey, CAST(row_number() OVER (ORDER BY s_nationkey) AS BIGINT) AS state_id
      FROM (SELECT DISTINCT s_nationkey FROM supplier) t)
    SELECT l_orderkey, l_linenumber, l_partkey, category_id, state_id,
    CAST(extract(year FROM l_shipdate) AS INT) AS year,
    CAST(extract(month FROM l_shipdate) AS INT) AS month
    FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN cat ON part.p_type = cat.p_type
    JOIN supplier ON l_suppkey = s_suppkey JOIN st ON st.s_nationkey = supplier.s_nationkey"""
)
def reviews_fact(t: Tables) -> DataFrame:
    """Lines under the ids of their part's type and their supplier's nation."""
    labelled = t.part.filter(F.col("p_type") != "PROMO")
    category = dimension_with_id(labelled, "p_type", "category_id")
    state = dimension_with_id(t.supplier, "s_nationkey", "state_id")
    business = attach_dimension(
        t.part.select("p_partkey", "p_type"), category, "p_type", "category_id"
    )
    sellers = attach_dimension(
        t.supplier.select("s_suppkey", "s_nationkey"), state, "s_nationkey", "state_id", how="inner"
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
    )
    lines = match_inner(lines, business, {"l_partkey": "p_partkey"}, ["category_id"])
    return match_inner(lines, sellers, {"l_suppkey": "s_suppkey"}, ["state_id"]).drop("l_suppkey")
