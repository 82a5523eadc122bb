"""Catalog tables: every query writes, maintains and reads back real tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.operators.quality import non_empty_check as require_rows
from starwright.queries.registry import Tables, query
from starwright.schemas import schema
from starwright.sinks.files import write_parquet
from starwright.sinks.merge_targets import contents, create_merge_table
from starwright.sinks.tables import (
    RUN_COLUMN,
    append,
    append_with_serial,
    create_database,
    create_table,
    drop_table,
    load_dimension,
    recreate_table,
    replace_fact_interval,
    truncate_load,
    upsert_ignore,
    upsert_update,
)
from starwright.storage import scratch_dir

TIMESTAMP = T.TimestampNTZType()


def _fresh_database(t: Tables) -> str:
    location = scratch_dir(t.spark, "db")
    return create_database(t.spark, "starwright_" + location[-12:], location)


def _fresh_table(
    t: Tables, label: str, columns: T.StructType, partition_by: tuple[str, ...] = ()
) -> str:
    table = f"{_fresh_database(t)}.{label}"
    create_table(t.spark, table, columns, partition_by)
    return table


def _fresh_target(t: Tables, label: str, columns: T.StructType, *keys: str, ledger: bool) -> str:
    table = f"{_fresh_database(t)}.{label}"
    create_merge_table(t.spark, table, columns, keys, buckets=4, ledger=ledger)
    return table


@query(
    """SELECT o_orderkey AS playid, CAST(extract(month FROM o_orderdate) AS VARCHAR) AS month
    FROM orders"""
)
def positional_insert(t: Tables) -> DataFrame:
    """An integer month lands in a text column of another name; loaded twice, replaced once."""
    table = _fresh_table(t, "plays", schema(playid="long", month="text"))
    plays = t.orders.select("o_orderkey", F.month("o_orderdate"))
    load_dimension(t.spark, table, plays)
    plays.createOrReplaceTempView("plays_to_load")
    load_dimension(t.spark, table, "SELECT * FROM plays_to_load")
    require_rows(t.spark, table)
    return t.spark.table(table)


@query("SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders")
def append_two_batches(t: Tables) -> DataFrame:
    """Open orders first, the rest second; one of the two in a bounded number of files."""
    columns = schema(o_orderkey="long", o_orderdate=TIMESTAMP, o_orderstatus="text")
    path = scratch_dir(t.spark, "order-batches")
    orders = t.orders.select(*columns.names)
    write_parquet(orders.filter(F.col("o_orderstatus") == "O"), path, max_files=2)
    rest = orders.filter(F.col("o_orderstatus") != "O")
    table = _fresh_table(t, "orders", columns)
    append(t.spark.read.schema(columns).parquet(path), table)
    append(rest, table)
    return t.spark.table(table)


@query("SELECT p_brand, p_partkey, p_name FROM part")
def clustered_table_read(t: Tables) -> DataFrame:
    """Recreate, load clustered by brand, copy out, drop."""
    columns = schema(p_brand="text", p_partkey="long", p_name="text")
    table = _fresh_table(t, "parts", columns)
    recreate_table(t.spark, table, columns)
    truncate_load(t.part.select(*columns.names), table, cluster_by=["p_brand"])
    path = scratch_dir(t.spark, "parts-by-brand")
    write_parquet(t.spark.table(table), path, cluster_by=["p_brand"], sort_by=["p_partkey"])
    drop_table(t.spark, table)
    return t.spark.read.parquet(path)


BATCH = "CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE 1 END"


@query(
    f"""SELECT f.user_id, f.props AS first_props, l.event_type AS level FROM
    (SELECT * FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id ORDER BY {BATCH}, event_id) AS rn FROM events) a WHERE rn = 1) f
    JOIN (SELECT * FROM (SELECT *, row_number() OVER
      (PARTITION BY user_id ORDER BY {BATCH} DESC, event_id DESC) AS rn FROM events) b
      WHERE rn = 1) l ON f.user_id = l.user_id"""
)
def upsert_update_two_batches(t: Tables) -> DataFrame:
    """Views and clicks merge first, all else second: first props stay, levels move on."""
    columns = schema(user_id="long", first_props="text", level="text")
    table = _fresh_target(t, "users", columns, "user_id", ledger=False)
    events = t.events.select(
        "user_id", F.col("props").alias("first_props"), F.col("event_type").alias("level"), "event_id"
    )
    first_batch = F.col("level").isin("view", "click")
    for batch in (events.filter(first_batch), events.filter(~first_batch)):
        upsert_update(batch, table, ["user_id"], ["event_id"], ["level"])
    return contents(t.spark, table)


@query(
    f"""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY {BATCH}, event_id) AS rn FROM events) t WHERE rn = 1"""
)
def upsert_ignore_two_batches(t: Tables) -> DataFrame:
    """Views and clicks go in first; users they bring stay as they are."""
    columns = schema(user_id="long", event_id="long", value="double")
    table = _fresh_target(t, "users", columns, "user_id", ledger=True)
    first_batch = F.col("event_type").isin("view", "click")
    for batch in (t.events.filter(first_batch), t.events.filter(~first_batch)):
        upsert_ignore(batch.select("user_id", "event_id", "value"), table, ["user_id"], ["event_id"])
    return contents(t.spark, table)


@query(
    """SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id,
    count(*) AS last_id FROM orders"""
)
def serial_append(t: Tables) -> DataFrame:
    """Two batches under one run of serial numbers without gaps."""
    table = _fresh_table(t, "orders", schema(id="long", o_orderkey="long"))
    is_open = F.col("o_orderstatus") == "O"
    for batch in (t.orders.filter(is_open), t.orders.filter(~is_open)):
        append_with_serial(batch.select("o_orderkey"), table, "id", gapless=True)
    return t.spark.table(table).agg(
        F.count("id").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query(
    """SELECT o_orderstatus = 'O' AS is_open, count(*) AS n_rows, count(*) AS n_ids,
    o_orderstatus = 'O' AS first_ids FROM orders GROUP BY o_orderstatus = 'O'"""
)
def serial_blocks(t: Tables) -> DataFrame:
    """Two batches numbered in one write each; the first one's ids come before the second's."""
    table = _fresh_table(t, "orders", schema(id="long", o_orderkey="long", is_open="bool"))
    is_open = F.col("o_orderstatus") == "O"
    for batch in (t.orders.filter(is_open), t.orders.filter(~is_open)):
        append_with_serial(batch.select("o_orderkey", is_open), table, "id")
    ids = t.spark.table(table).groupBy("is_open").agg(
        F.count("id").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.max("id").alias("last"),
        F.min("id").alias("first"),
    )
    # One row for each batch, beside the other batch's least id.
    others = ids.select((~F.col("is_open")).alias("is_open"), F.col("first").alias("other_first"))
    return ids.join(others, "is_open").select(
        "is_open", "n_rows", "n_ids", (F.col("last") < F.col("other_first")).alias("first_ids")
    )


@query(
    """SELECT l_shipdate, count(*) AS n_rows FROM lineitem
    WHERE l_shipdate >= DATE '1995-03-01' AND l_shipdate < DATE '1995-06-01' GROUP BY l_shipdate"""
)
def sort_key_range(t: Tables) -> DataFrame:
    """Lines loaded in the order of their day; a range of days reads the files that hold it."""
    columns = schema(l_shipdate=t.lineitem.schema["l_shipdate"].dataType, l_orderkey="long")
    table = _fresh_table(t, "lines", columns)
    truncate_load(t.lineitem.select(*columns.names), table, sort_key=["l_shipdate"])
    day = F.col("l_shipdate")
    some = t.spark.table(table).filter((day >= F.lit("1995-03-01")) & (day < F.lit("1995-06-01")))
    return some.groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """SELECT event_id, user_id, ts,
    CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN '2024-01-15' ELSE '2024-02-01' END
      AS load_until
    FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-01' AND CAST(ts AS DATE) <= DATE '2024-02-01'"""
)
def repeatable_interval_load(t: Tables) -> DataFrame:
    """Two runs, the second one twice: each replaces its own slice only."""
    columns = schema(event_id="long", user_id="long", ts=TIMESTAMP, **{RUN_COLUMN: T.DateType()})
    table = _fresh_table(t, "facts", columns, (RUN_COLUMN,))
    events = t.events.select("event_id", "user_id", "ts")
    for execution in (date(2024, 1, 15), date(2024, 2, 1), date(2024, 2, 1)):
        replace_fact_interval(t.spark, table, events, "ts", execution)
    return t.spark.table(table).withColumn(RUN_COLUMN, F.col(RUN_COLUMN).cast("string"))
