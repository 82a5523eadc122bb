"""Joins: semantics on small frames, and hot keys beyond the broadcast size."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from starwright.operators.matching import (
    attach_dimension,
    lookup_first,
    match_catalog,
    match_inner,
    match_left,
)
from starwright.plans.reviews import business_reviews

ON = {"song": "title", "artist": "name"}


@pytest.fixture
def plays(spark):
    rows = [(1, "s", "a"), (2, "s", "b"), (3, None, "a"), (4, "t", "a"), (5, "s", "a")]
    return spark.createDataFrame(rows, "id int, song string, artist string")


@pytest.fixture
def catalog(spark):
    rows = [("S2", "s", "a"), ("S1", "s", "a"), ("S3", "t", "x"), ("S4", None, "a")]
    return spark.createDataFrame(rows, "song_id string, title string, name string")


def test_inner_fans_out(plays, catalog):
    got = match_inner(plays, catalog, ON, ["song_id"]).select("id", "song_id")
    assert sorted(map(tuple, got.collect())) == [(1, "S1"), (1, "S2"), (5, "S1"), (5, "S2")]


def test_left_keeps_unmatched_and_null_keys(plays, catalog):
    got = match_left(plays, catalog, ON, {"song_id": "found"}).select("id", "found")
    assert Counter(map(tuple, got.collect())) == Counter(
        [(1, "S1"), (1, "S2"), (2, None), (3, None), (4, None), (5, "S1"), (5, "S2")]
    )


def test_lookup_takes_the_smallest(plays, catalog):
    got = lookup_first(plays, catalog, ON, ["song_id"])
    assert got.columns == ["id", "song", "artist", "song_id"]
    assert sorted((row.id, row.song_id) for row in got.collect()) == [
        (1, "S1"), (2, None), (3, None), (4, None), (5, "S1"),
    ]


def test_mixed_key_types_are_refused(plays, catalog):
    wider = plays.withColumn("title", F.col("id").cast("long")).drop("song")
    for match in (match_left, lookup_first):
        with pytest.raises(ValueError, match="cast one of them"):
            match(wider, catalog, {"title": "title"}, ["song_id"])


def test_other_join_kinds_are_refused(plays, catalog):
    with pytest.raises(ValueError):
        match_catalog(plays, catalog, ON, ["song_id"], "full")


def test_attach_dimension(spark, plays):
    dim = spark.createDataFrame([("a", 7)], "artist string, artist_id int")
    left = attach_dimension(plays, dim, "artist", "artist_id")
    assert left.columns == ["id", "song", "artist_id"] and left.count() == 5
    assert attach_dimension(plays, dim, "artist", "artist_id", how="inner").count() == 4


HOT = 7


@pytest.fixture
def hot_frames(spark, conf, tmp_path):
    """200,000 rows, a third of them under one key, and a catalog too big to broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="16KB",
    )
    key = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 5000)
    spark.range(0, 200_000, 1, 8).select(key.alias("k"), F.col("id").alias("v")).write.parquet(
        f"{tmp_path}/rows"
    )
    spark.range(20_000).select((F.col("id") % 4000).alias("c"), F.col("id").alias("sid")).write.parquet(
        f"{tmp_path}/catalog"
    )
    return spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/catalog")


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_key_is_split_in_a_left_match(hot_frames):
    rows, catalog = hot_frames
    unique = catalog.filter(F.col("sid") < 4000)
    got = match_left(rows, unique, {"k": "c"}, ["sid"])
    result = got.toPandas()
    assert "skew=true" in _final_plan(got)
    assert len(result) == 200_000
    known = result["k"] < 4000
    assert (result.loc[known, "sid"] == result.loc[known, "k"]).all()
    assert result.loc[~known, "sid"].isna().all()


def test_null_keys_are_split_in_a_left_match(hot_frames):
    rows, catalog = hot_frames
    blank = rows.withColumn("k", F.when(F.col("k") != HOT, F.col("k")))
    got = match_left(blank, catalog.filter(F.col("sid") < 4000), {"k": "c"}, ["sid"])
    result = got.toPandas()
    assert "skew=true" in _final_plan(got)
    assert len(result) == 200_000
    assert result.loc[result["k"].isna(), "sid"].isna().all()


def test_hot_business_is_split_in_the_review_fact(hot_frames):
    rows, catalog = hot_frames
    reviews = rows.select(
        F.col("v").cast("string").alias("review_id"), F.lit("u").alias("user_id"),
        F.col("k").cast("string").alias("business_id"), F.lit(1.0).alias("stars"),
        F.lit("2018-01-02").alias("date"), F.lit(0).alias("cool"), F.lit(0).alias("funny"),
        F.lit(0).alias("useful"),
    )
    unique = catalog.filter(F.col("sid") < 4000)
    business = unique.select(F.col("c").cast("string").alias("business_id"), "sid")
    got = business_reviews(business, reviews)
    result = got.toPandas()
    assert "skew=true" in _final_plan(got)
    assert len(result) == rows.filter(F.col("k") < 4000).count()
    assert (result["sid"] == result["business_id"].astype(int)).all()


def test_hot_key_is_split_in_a_lookup(hot_frames):
    rows, catalog = hot_frames
    got = lookup_first(rows, catalog, {"k": "c"}, ["sid"])
    result = got.toPandas()
    assert "skew=true" in _final_plan(got)
    assert len(result) == 200_000
    known = result["k"] < 4000
    assert (result.loc[known, "sid"] == result.loc[known, "k"]).all()
    assert result.loc[~known, "sid"].isna().all()
