from datetime import date
from pathlib import Path
from random import Random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starwright.operators.merges import keyed_last_write, merged_rows, rows_to_insert
from starwright.schemas import schema
from starwright.sinks.tables import (
    append,
    append_with_serial,
    create_table,
    drop_table,
    load_fact_interval,
    recreate_table,
    replace_contents,
    replace_fact_interval,
    truncate_load,
    upsert_ignore,
    upsert_update,
)
from starwright.storage import folders

USERS = "id int, name string, level string, at int"
COLUMNS = ["id", "name", "level"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_write_wins(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "b", "y", 3), (2, "c", "z", 2)], USERS)
    assert rows(keyed_last_write(df, ["id"], ["at"], COLUMNS)) == [(1, "b", "y"), (2, "c", "z")]


def test_insert_keeps_what_is_there(spark):
    new = spark.createDataFrame([(1, "late", "y", 9), (1, "early", "x", 1), (2, "n", "z", 2)], USERS)
    assert rows(rows_to_insert(None, new, ["id"], ["at"], COLUMNS)) == [(1, "early", "x"), (2, "n", "z")]
    target = spark.createDataFrame([(2, "old", "o")], "id int, name string, level string")
    assert rows(rows_to_insert(target, new, ["id"], ["at"], COLUMNS)) == [(1, "early", "x")]


def test_merge_updates_only_the_chosen_columns(spark):
    target = spark.createDataFrame([(1, "old", "free"), (3, None, "paid")], "id int, name string, level string")
    new = spark.createDataFrame(
        [(1, "new", "paid", 1), (1, "newer", None, 2), (2, None, "free", 1), (2, "b", "paid", 2)], USERS
    )
    # Nulls are values: a null written last, or first, stays.
    assert rows(merged_rows(target, new, ["id"], ["at"], COLUMNS, ["level"])) == [
        (1, "old", None), (2, None, "paid"), (3, None, "paid"),
    ]


def test_merge_with_every_column_updated_or_none(spark):
    target = spark.createDataFrame([(1, "old", "free")], "id int, name string, level string")
    new = spark.createDataFrame([(1, "new", "paid", 1)], USERS)
    assert rows(merged_rows(target, new, ["id"], ["at"], COLUMNS, ["name", "level"])) == [(1, "new", "paid")]
    assert rows(merged_rows(target, new, ["id"], ["at"], COLUMNS, [])) == [(1, "old", "free")]


@pytest.mark.parametrize(
    "merge",
    [
        lambda df: keyed_last_write(df, ["id"], ["at"], COLUMNS),
        lambda df: rows_to_insert(None, df, ["id"], ["at"], COLUMNS),
        lambda df: merged_rows(None, df, ["id"], ["at"], COLUMNS, ["level"]),
    ],
)
def test_null_keys_fail(spark, merge):
    df = spark.createDataFrame([(None, "a", "x", 1), (1, "b", "y", 1)], USERS)
    with pytest.raises(PySparkException, match="null in key column id"):
        merge(df).collect()


def test_hot_key_folds_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("id"), F.lit("n").alias("name"), F.lit("l").alias("level"), F.col("id").alias("at")
    )
    plan = merged_rows(None, df, ["id"], ["at"], COLUMNS, ["level"])._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "partial_min(" in text[text.index("Exchange"):]


def test_rows_without_an_order_lose(spark):
    df = spark.createDataFrame([(1, "a", "x", None), (1, "b", "y", 5), (1, "c", "z", 3)], USERS)
    assert rows(keyed_last_write(df, ["id"], ["at"], COLUMNS)) == [(1, "b", "y")]
    assert rows(rows_to_insert(None, df, ["id"], ["at"], COLUMNS)) == [(1, "c", "z")]
    assert rows(merged_rows(None, df, ["id"], ["at"], COLUMNS, ["level"])) == [(1, "c", "y")]


def test_table_upserts(spark, database):
    table = f"{database}.users"
    create_table(spark, table, schema(id="int", name="text", level="text"))
    first = spark.createDataFrame([(1, "a", "free", 1), (2, "b", "free", 2)], USERS)
    second = spark.createDataFrame([(2, "B", "paid", 3), (3, "c", "paid", 4)], USERS)
    upsert_update(first, table, ["id"], ["at"], ["level"])
    upsert_update(second, table, ["id"], ["at"], ["level"])
    assert rows(spark.table(table)) == [(1, "a", "free"), (2, "b", "paid"), (3, "c", "paid")]
    upsert_ignore(spark.createDataFrame([(3, "x", "x", 1), (4, "d", "free", 1)], USERS), table, ["id"], ["at"])
    assert rows(spark.table(table))[2:] == [(3, "c", "paid"), (4, "d", "free")]


def test_replace_contents_may_read_its_table(spark, database):
    table = f"{database}.t"
    create_table(spark, table, schema(v="int"))
    append(spark.createDataFrame([(1,), (2,)], "v int"), table)
    before = spark.table(table)
    replace_contents(before.select(F.col("v") * 10), table)
    replace_contents(spark.table(table).select(F.col("v") + 1), table)
    assert rows(spark.table(table)) == [(11,), (21,)]
    (previous,) = {name.rsplit("/", 1)[0] for name in spark.table(table).inputFiles()}
    replace_contents(spark.table(table).filter("v > 11"), table, keep_previous=False)
    assert rows(spark.table(table)) == [(21,)]
    assert not Path(previous.removeprefix("file://")).exists()
    append(spark.createDataFrame([(5,)], "v int"), table)
    assert rows(spark.table(table)) == [(21,), (5,)]


def test_truncate_load_replaces_and_append_adds(spark, database):
    table = f"{database}.t"
    create_table(spark, table, schema(a="long", b="text"))
    df = spark.createDataFrame([(1, 5), (2, 6)], "x int, y int")
    for _ in range(2):
        truncate_load(df, table)
    assert rows(spark.table(table)) == [(1, "5"), (2, "6")]
    append(df, table)
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError, match="3 columns for a target of 2"):
        append(df.withColumn("z", F.lit(1)), table)
    create_table(spark, table, schema(a="long", b="text"))
    assert spark.table(table).count() == 4
    recreate_table(spark, table, schema(a="long", b="text"))
    assert spark.table(table).count() == 0
    drop_table(spark, table)
    drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_serial_goes_on(spark, database):
    table = f"{database}.t"
    create_table(spark, table, schema(id="long", v="long"))
    append_with_serial(spark.range(5).select(F.col("id").alias("v")), table, "id", gapless=True)
    append_with_serial(spark.range(3).select(F.col("id").alias("v")), table, "id", gapless=True)
    assert sorted(row.id for row in spark.table(table).collect()) == list(range(1, 9))


@pytest.mark.parametrize("as_sql", [False, True])
def test_fact_intervals_append_or_replace(spark, database, as_sql):
    events = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2018-11-15 23:59:59'), (2, timestamp'2018-11-16 00:00:00'), "
        "(3, timestamp'2018-12-01 23:00:00'), (4, timestamp'2018-12-02 00:00:00') AS t(id, at)"
    )
    events.createOrReplaceTempView("interval_events")
    query = "SELECT id, at FROM interval_events" if as_sql else events
    plain, by_run = f"{database}.plain", f"{database}.by_run"
    create_table(spark, plain, schema(id="int", at="time"))
    columns = schema(id="int", at="time", load_until=T.DateType())
    create_table(spark, by_run, columns, partition_by=["load_until"])
    for _ in range(2):
        load_fact_interval(spark, plain, query, "at", date(2018, 12, 1))
        replace_fact_interval(spark, by_run, query, "at", date(2018, 12, 1))
    replace_fact_interval(spark, by_run, query, "at", date(2018, 11, 15))
    assert sorted(row.id for row in spark.table(plain).collect()) == [2, 2, 3, 3]
    assert sorted(row.id for row in spark.table(by_run).collect()) == [1, 2, 3]
    # A run that finds nothing any more empties its own slice only.
    replace_fact_interval(spark, by_run, events.filter("id > 3"), "at", date(2018, 12, 1))
    assert sorted(row.id for row in spark.table(by_run).collect()) == [1]


def _random_batches(seed):
    """Three batches of rows with unique orders, many keys, nulls, and one hot key."""
    random = Random(seed)
    orders = list(range(3000))
    random.shuffle(orders)
    batches = [[], [], []]
    for at in orders:
        key = 0 if random.random() < 0.33 else random.randrange(400)
        name = random.choice(["a", "b", "c", None])
        level = random.choice(["free", "paid", None])
        batches[random.randrange(3)].append((key, name, level, at))
    return batches


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merges_against_row_by_row_upserts(spark, seed):
    updated, ignored, last = {}, {}, {}
    merged = kept = None
    for batch in _random_batches(seed):
        for key, name, level, _ in sorted(batch, key=lambda row: row[3]):
            updated[key] = (updated[key][0] if key in updated else name, level)
            ignored.setdefault(key, (name, level))
        df = spark.createDataFrame(batch, USERS).repartition(7)
        merged = merged_rows(merged, df, ["id"], ["at"], COLUMNS, ["level"])
        added = rows_to_insert(kept, df, ["id"], ["at"], COLUMNS)
        kept = added if kept is None else kept.unionByName(added)
    assert {row.id: (row.name, row.level) for row in merged.collect()} == updated
    assert {row.id: (row.name, row.level) for row in kept.collect()} == ignored
    everything = [row for batch in _random_batches(seed) for row in batch]
    for key, name, level, _ in sorted(everything, key=lambda row: row[3]):
        last[key] = (name, level)
    df = spark.createDataFrame(everything, USERS).repartition(7)
    got = keyed_last_write(df, ["id"], ["at"], COLUMNS)
    assert {row.id: (row.name, row.level) for row in got.collect()} == last


def test_dropping_a_table_removes_all_its_versions(spark, database):
    table, columns = f"{database}.versions", schema(id="int", v="int")
    create_table(spark, table, columns)
    append(spark.createDataFrame([(1, 1)], columns), table)
    for v in (2, 3, 4):
        batch = spark.createDataFrame([(1, v), (v, v)], columns)
        upsert_update(batch, table, ["id"], ["v"], ["v"])
    first = spark.table(table).inputFiles()[0].rsplit("/", 2)[0]
    found = folders(spark, f"{first}/versions*")
    assert len(found) == 2  # the present version and the one before
    recreate_table(spark, table, columns)
    assert spark.table(table).count() == 0 and len(folders(spark, f"{first}/versions*")) == 1
    drop_table(spark, table)
