"""File round trips: what is written must come back the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.queries.registry import Tables, query
from starwright.schemas import schema
from starwright.sinks.files import write_csv, write_json, write_parquet
from starwright.sinks.tables import create_database, create_table
from starwright.sources.files import read_csv, read_json
from starwright.sources.ledger import FileLedger
from starwright.sources.staging import (
    create_staging_archive,
    coerce_to_schema,
    map_fields,
    stage_new_files,
    stage_table,
)
from starwright.storage import scratch_dir


@query(
    """SELECT o_orderkey, o_custkey, CAST(extract(year FROM o_orderdate) AS INT) AS year
    FROM orders WHERE extract(year FROM o_orderdate) = 1997"""
)
def partitioned_write_pruned_read(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "orders-by-year")
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    write_parquet(orders, path, partition_by=["year"], keep_partition_columns=True)
    back = t.spark.read.parquet(path)
    return back.filter(F.col("yearp") == 1997).select("o_orderkey", "o_custkey", "year")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def roundtrip_json_stage(t: Tables) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    path = scratch_dir(t.spark, "orders-json")
    write_json(t.orders.select(*columns, F.year("o_orderdate").alias("year")), path)
    source = schema(o_orderkey="long", o_custkey="long", o_orderstatus="text", o_totalprice="double")
    return coerce_to_schema(read_json(t.spark, path, source), source)


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def roundtrip_csv_quote_all(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "customer-csv")
    target = schema(c_custkey="long", c_name="text", c_acctbal="double", c_mktsegment="text")
    write_csv(t.customer, path, columns=target.names)
    return read_csv(t.spark, path, target)


@query("SELECT doc_id, lang, text FROM documents")
def roundtrip_csv_free_text(t: Tables) -> DataFrame:
    """Whole texts with quotes, commas and line ends survive quoting."""
    path = scratch_dir(t.spark, "documents-csv")
    target = schema(doc_id="long", lang="text", text="text")
    write_csv(t.documents, path, columns=target.names)
    return read_csv(t.spark, path, target, multiline=True)


@query("SELECT event_id AS item_id, user_id AS user_key, event_type AS page FROM events")
def json_field_mapping(t: Tables) -> DataFrame:
    """Text fields under a dated path, renamed and cast by a field list."""
    root = scratch_dir(t.spark, "events-json")
    texts = t.events.select(
        F.struct(F.col("event_id").cast("string").alias("id")).alias("item"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("event_type").alias("page"),
    )
    write_json(texts, f"{root}/2024-01-15")
    source = schema(item=schema(id="text"), userId="text", page="text")
    raw = read_json(t.spark, root + "/{run_date}", source, params={"run_date": "2024-01-15"})
    mapped = map_fields(raw, [("item.id", "item_id"), ("userId", "user_key"), ("page", "page")])
    return coerce_to_schema(mapped, schema(item_id="long", user_key="long", page="text"))


def _orders_tree(t: Tables) -> tuple[str, T.StructType]:
    """Orders as JSON in directories two levels deep, without their paths' values."""
    root = scratch_dir(t.spark, "orders-tree")
    columns = schema(o_orderkey="long", o_totalprice="double", o_orderstatus="text")
    nested = t.orders.select(
        *columns.names, F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p")
    )
    write_json(nested, root, partition_by=["y", "p"])
    return root, columns


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def recursive_json_scan(t: Tables) -> DataFrame:
    root, columns = _orders_tree(t)
    return read_json(t.spark, root, columns, recursive=True)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def glob_json_scan(t: Tables) -> DataFrame:
    root, columns = _orders_tree(t)
    return read_json(t.spark, f"{root}/*/*/*.json", columns)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def json_scan_in_partitions(t: Tables) -> DataFrame:
    """The tree read into a given number of partitions."""
    root, columns = _orders_tree(t)
    return read_json(t.spark, root, columns, recursive=True, partitions=13)


def _fresh_database(t: Tables) -> str:
    location = scratch_dir(t.spark, "db")
    return create_database(t.spark, "starwright_" + location[-12:], location)


@query(
    """SELECT c_custkey, c_name, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, c_mktsegment
    FROM customer"""
)
def stage_csv_table(t: Tables) -> DataFrame:
    """CSV staged into a typed table, twice: by position, fractions dropped, rows replaced."""
    path = scratch_dir(t.spark, "customer-stage")
    target = schema(c_custkey="long", c_name="varchar", c_acctbal="number", c_mktsegment="varchar")
    write_csv(t.customer, path, columns=target.names)
    table = f"{_fresh_database(t)}.customer"
    create_table(t.spark, table, target)
    raw = schema(key="text", name="text", balance="text", segment="text")
    for _ in range(2):
        stage_table(t.spark, table, path, raw, is_csv=True)
    return t.spark.table(table).withColumn("c_acctbal", F.col("c_acctbal").cast("long"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def stage_files_once(t: Tables) -> DataFrame:
    """Files come in two deliveries and are looked for three times; each is staged once."""
    database, path = _fresh_database(t), scratch_dir(t.spark, "orders-deliveries")
    columns = schema(o_orderkey="long", o_totalprice="double", o_orderstatus="text")
    table, ledger = f"{database}.orders", FileLedger(t.spark, f"{database}.files")
    create_staging_archive(t.spark, table, columns)
    is_open = F.col("o_orderstatus") == "O"
    for label, rows in (("a", t.orders.filter(is_open)), ("b", t.orders.filter(~is_open)), ("b", None)):
        if rows is not None:
            write_json(rows.select(*columns.names), f"{path}/{label}")
        stage_new_files(t.spark, table, path, columns, ledger, is_json=True)
    return t.spark.table(table).select(*columns.names)
