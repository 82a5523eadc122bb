from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starwright.operators.dimensions import (
    dimension_with_id,
    distinct_dimension,
    first_per_key,
    latest_per_key,
    numbered,
    ranked_per_key,
    surrogate_key,
    time_dimension,
)


def test_distinct_with_rename(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", 8), (None, "a", 7)], "k int, v string, w int")
    got = distinct_dimension(df, {"k": "id", "v": "name"})
    assert got.columns == ["id", "name"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (None, "a")]


def test_latest_treats_null_as_oldest_and_breaks_ties(spark):
    rows = [(1, None, "z"), (1, 5, "a"), (1, 5, "b"), (2, None, "q"), (None, 9, "x")]
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    got = latest_per_key(df, ["k"], ["ts"], {"v": "value", "k": "key"})
    assert got.columns == ["value", "key"]
    assert sorted(map(tuple, got.collect())) == [("b", 1), ("q", 2)]
    kept = latest_per_key(df, ["k"], ["ts"], ["k", "v"], drop_null_keys=False)
    assert (None, "x") in map(tuple, kept.collect())
    first = first_per_key(df, ["k"], ["ts"], ["k", "v"])
    assert sorted(map(tuple, first.collect())) == [(1, "a"), (2, "q")]


def test_ranked_mixes_directions(spark):
    rows = [("a", None, 1.0), ("a", 2.0, 3.0), ("a", 2.0, None), ("b", None, 1.0), ("b", None, 5.0)]
    df = spark.createDataFrame(rows, "k string, lat double, lon double")
    order = [F.col("lat").asc_nulls_last(), F.col("lon").desc_nulls_first()]
    got = ranked_per_key(df, ["k"], order, ["k", "lat", "lon"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 2.0, None), ("b", None, 5.0)]


def before_shuffle(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Exchange"):]


def test_one_row_per_key_and_task_is_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    assert "partial_max" in before_shuffle(latest_per_key(df, ["k"], ["ts"], ["k", "ts"]))
    assert "partial_min" in before_shuffle(first_per_key(df, ["k"], ["ts"], ["k", "ts"]))
    ranked = before_shuffle(ranked_per_key(df, ["k"], [F.col("ts").asc()], ["k", "ts"]))
    assert "WindowGroupLimit" in ranked and "Partial" in ranked


def test_hot_key_over_many_rows(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    df = spark.range(0, 300_000, 1, 16).select(key.alias("k"), F.col("id").alias("ts"))
    got = {row.k: row.ts for row in latest_per_key(df, ["k"], ["ts"], ["k", "ts"]).collect()}
    expected = {}
    for i in range(300_000):
        expected[7 if i % 3 == 0 else i % 1000] = i
    assert got == expected


def test_time_dimension_dedupes_on_request(spark):
    stamp = datetime(2018, 11, 25, 1, 2, 3)
    df = spark.createDataFrame([(stamp,), (stamp,)], "ts timestamp")
    assert time_dimension(df, "ts", weekday_encoding="one").count() == 1
    kept = time_dimension(df, "ts", weekday_encoding="zero", dedupe=False)
    assert [tuple(row)[1:] for row in kept.collect()] == [(1, 25, 47, 11, 2018, 0)] * 2
    assert kept.columns == ["start_time", "hour", "day", "week", "month", "year", "weekday"]


@pytest.mark.parametrize("rows", [0, 1, 7, 5000])
def test_surrogate_keys_are_dense_and_ordered(spark, conf, rows):
    conf(adaptive__coalescePartitions__enabled="false")
    df = spark.range(rows).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    got = surrogate_key(df.repartition(5), ["k"], "id").orderBy("k").collect()
    assert [row["id"] for row in got] == list(range(1, rows + 1))


def test_surrogate_keys_need_no_single_task_sort_of_the_rows(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    plan = surrogate_key(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("SinglePartition"):]
    assert "HashAggregate(keys=[_part" in single  # only per-partition counts come together


def test_numbered_starts_anywhere(spark):
    got = numbered(spark.range(10).repartition(3), "n", start=101)
    assert sorted(row.n for row in got.collect()) == list(range(101, 111))


def test_dimension_with_id_skips_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "v string")
    got = dimension_with_id(df, "v", "v_id").orderBy("v_id").collect()
    assert list(map(tuple, got)) == [("a", 1), ("b", 2)]
