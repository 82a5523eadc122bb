"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.functions.cleaning import (
    first_contained_label,
    first_true_label,
    last_item_is,
    list_size,
    null_if,
    python_flags,
    python_literal,
    text_to_boolean,
)
from starwright.functions.timeparts import (
    calendar_parts,
    from_epoch_ms,
    from_epoch_ms_as_seconds,
    text_to_timestamp,
)
from starwright.operators.quality import row_count_report
from starwright.plans.lookups import with_artist
from starwright.plans.reviews import AMBIENCES, NO_AMBIENCE
from starwright.queries.registry import Tables, query
from starwright.schemas import schema
from starwright.sources.staging import coerce_to_schema


@query("SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'")
def scan_filter_project(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "view").select(
        "event_id", "user_id", "ts", "value"
    )


@query(
    """SELECT event_id, half FROM (SELECT event_id, value / 2 AS half, event_type FROM events) t
    WHERE event_type = 'click'"""
)
def derived_table_filter(t: Tables) -> DataFrame:
    derived = t.events.select("event_id", (F.col("value") / 2).alias("half"), "event_type")
    return derived.filter(F.col("event_type") == "click").select("event_id", "half")


@query(
    """SELECT doc_id, lang, artist FROM
    (SELECT doc_id, lang, CASE WHEN source = 'src0' THEN '' ELSE source END AS artist FROM documents) t
    WHERE artist <> '' AND lang <> 'fr'"""
)
def drop_empty_and_sentinel(t: Tables) -> DataFrame:
    blanked = F.when(F.col("source") == "src0", "").otherwise(F.col("source"))
    rows = t.documents.select("doc_id", "lang", blanked.alias("artist"))
    return with_artist(rows).filter(F.col("lang") != "fr")


@query(
    """SELECT l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey = 100 AND l_linestatus = 'O' ORDER BY l_linenumber"""
)
def lookup_two_keys_ordered(t: Tables) -> DataFrame:
    here = (F.col("l_orderkey") == 100) & (F.col("l_linestatus") == "O")
    return (
        t.lineitem.filter(here)
        .select("l_linenumber", "l_partkey", "l_quantity")
        .orderBy(F.col("l_linenumber").asc_nulls_last())
    )


@query("SELECT p_partkey, p_brand FROM part WHERE p_name = 'red widget'")
def lookup_by_text(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name") == "red widget").select("p_partkey", "p_brand")


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5")
def preview_first_rows(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type").orderBy("event_id").limit(5)


@query(
    """SELECT c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT s_suppkey, s_name FROM supplier"""
)
def multi_file_union(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


@query("SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) > 0 AS passed FROM orders")
def non_empty_check(t: Tables) -> DataFrame:
    return row_count_report(t.orders, "orders")


@query(
    """SELECT event_id, epoch_ms(epoch_us(ts) // 1000) AS ts_ms,
    epoch_ms((epoch_us(ts) // 1000000) * 1000) AS ts_s FROM events"""
)
def epoch_ms_to_timestamp(t: Tables) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id",
        from_epoch_ms(ms).cast("timestamp_ntz").alias("ts_ms"),
        from_epoch_ms_as_seconds(ms).cast("timestamp_ntz").alias("ts_s"),
    )


@query(
    """SELECT event_id, CAST(extract(hour FROM ts) AS INT) AS hour,
    CAST(extract(day FROM ts) AS INT) AS day, CAST(extract(week FROM ts) AS INT) AS week,
    CAST(extract(month FROM ts) AS INT) AS month, CAST(extract(year FROM ts) AS INT) AS year,
    dayname(ts) AS weekday FROM events"""
)
def calendar_parts_of_events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").select(
        "event_id", *[part.alias(name) for name, part in calendar_parts(F.col("ts"), "name").items()]
    )


@query(
    """SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(extract(year FROM o_orderdate) AS INT) END AS year,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(extract(month FROM o_orderdate) AS INT) END AS month
    FROM orders"""
)
def text_date_parts(t: Tables) -> DataFrame:
    written_date = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 7 == 0, "not a date").otherwise(written_date)
    parsed = t.orders.select("o_orderkey", text_to_timestamp(text).alias("parsed"))
    return parsed.select(
        "o_orderkey", F.year("parsed").alias("year"), F.month("parsed").alias("month")
    )


@query(
    """SELECT event_id, nullif(CASE WHEN event_type = 'click' THEN 'none'
    WHEN event_type = 'error' THEN NULL ELSE event_type END, 'none') AS alcohol FROM events"""
)
def python_literal_unquote(t: Tables) -> DataFrame:
    literal = (
        F.when(F.col("event_type") == "click", F.lit("u'none'"))
        .when(F.col("event_type") == "error", F.lit("None"))
        .otherwise(F.concat(F.lit("'"), F.col("event_type"), F.lit("'")))
    )
    return t.events.select("event_id", null_if(python_literal(literal), "none").alias("alcohol"))


def _python_bool(condition):
    return F.when(condition, F.lit("True")).otherwise(F.lit("False"))


@query(
    """SELECT event_id, CASE WHEN CAST(props::json->>'$.k' AS INT) % 2 = 0 THEN 'classy'
    WHEN CAST(props::json->>'$.k' AS INT) % 3 = 0 THEN 'casual' ELSE 'N/A' END AS ambience
    FROM events"""
)
def ambience_priority_label(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.concat(
        F.lit("{'romantic': False, u'casual': "),
        _python_bool(k % 3 == 0),
        F.lit(", 'classy': "),
        _python_bool(k % 2 == 0),
        F.lit(", 'trendy': None}"),
    )
    flags = t.events.select("event_id", python_flags(text, AMBIENCES).alias("flags"))
    label = first_true_label(F.col("flags"), AMBIENCES, NO_AMBIENCE)
    return flags.select("event_id", label.alias("ambience"))


@query(
    """SELECT p_partkey, CASE WHEN p_name LIKE '%red%' THEN 'Red'
    WHEN p_name LIKE '%widget%' THEN 'Widget' WHEN p_name LIKE '%small%' THEN 'Small' END AS category
    FROM part"""
)
def category_like_label(t: Tables) -> DataFrame:
    labels = [("red", "Red"), ("widget", "Widget"), ("small", "Small")]
    return t.part.select(
        "p_partkey", first_contained_label(F.col("p_name"), labels).alias("category")
    )


@query(
    """WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ''
    WHEN c_custkey % 3 = 1 THEN '2012,2023' ELSE '2015' END AS elite FROM customer)
    SELECT c_custkey, CAST(len(string_split(elite, ',')) AS INT) AS friend_cnt,
    CAST(CASE WHEN length(elite) = 0 THEN 0 ELSE len(string_split(elite, ',')) END AS INT)
      AS elite_year_cnt,
    coalesce(TRY_CAST(split_part(elite, ',', -1) AS INT) = 2023, false) AS is_elite FROM u"""
)
def csv_list_counts(t: Tables) -> DataFrame:
    third = F.col("c_custkey") % 3
    elite = F.when(third == 0, "").when(third == 1, "2012,2023").otherwise("2015")
    listed = t.customer.select("c_custkey", elite.alias("elite"))
    return listed.select(
        "c_custkey",
        list_size(F.col("elite")).alias("friend_cnt"),
        list_size(F.col("elite"), empty_as_zero=True).alias("elite_year_cnt"),
        last_item_is(F.col("elite"), 2024 - 1).alias("is_elite"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN TRUE
    WHEN c_custkey % 3 = 1 THEN FALSE END AS good_for_kids FROM customer"""
)
def text_to_boolean_values(t: Tables) -> DataFrame:
    third = F.col("c_custkey") % 3
    text = F.when(third == 0, "True").when(third == 1, "False").otherwise("u'no'")
    return t.customer.select("c_custkey", text_to_boolean(text).alias("good_for_kids"))


@query("SELECT event_id, CAST(props::json->>'$.k' AS INT) AS k FROM events")
def nested_json_fields(t: Tables) -> DataFrame:
    parsed = F.from_json("props", schema(k="int")).alias("parsed")
    return t.events.select("event_id", parsed).select("event_id", F.col("parsed.k").alias("k"))


@query("SELECT doc_id, substr(text, 1, 256) AS text FROM documents")
def stage_truncate_columns(t: Tables) -> DataFrame:
    """The load option that cuts long text to the column's width."""
    return coerce_to_schema(t.documents, schema(doc_id="long", text="text"), {"text": 256})


@query("SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS acctbal FROM customer")
def stage_numeric_truncate(t: Tables) -> DataFrame:
    target = schema(c_custkey="long", c_acctbal=T.DecimalType(18, 0))
    staged = coerce_to_schema(t.customer, target)
    return staged.select("c_custkey", F.col("c_acctbal").cast("long").alias("acctbal"))
