"""F10 to F19: plays that match many copies of a song make far more rows than both sides have."""

from pyspark.sql import functions as F

from starwright.operators.matching import match_inner, match_left
from starwright.operators.quality import id_counts
from starwright.plans import incremental, warehouse
from starwright.sinks import tables as sinks
from starwright.sinks.files import write_parquet
from starwright.sources.ledger import listing


def size(spark, path):
    return listing(spark, path).where("path LIKE '%part-%'").agg(F.sum("size")).first()[0]


def test_matches_of_a_key_lie_side_by_side(spark):
    plays = spark.range(4000).select("id", (F.xxhash64("id") % 20).alias("song"))
    songs = spark.range(800).select((F.col("id") % 41 - 20).alias("title"), "id")
    for match in (match_inner, match_left):
        found = match(plays, songs, {"song": "title"}, {"id": "song_id"}, together=True)
        seen = set()
        for part in found.select("song", F.spark_partition_id().alias("p")).groupBy("p").agg(
            F.collect_list("song").alias("songs")
        ).collect():
            runs = [s for i, s in enumerate(part.songs) if i == 0 or part.songs[i - 1] != s]
            assert len(runs) == len(set(runs)) and not seen & set(runs)
            seen |= set(runs)
        plain = match(plays, songs, {"song": "title"}, {"id": "song_id"})
        assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_rows_in_place_are_written_without_a_shuffle(spark, tmp_path):
    rows = spark.range(40, numPartitions=2).withColumn("p", F.col("id") % 2)
    write_parquet(rows, f"{tmp_path}/out", partition_by=["p"], in_place=True)
    assert listing(spark, f"{tmp_path}/out").where("path LIKE '%part-%'").count() == 4
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [(i, i % 2) for i in range(40)]


def test_serials_take_little_room(spark, database):
    location = {}
    for name, options in (("plain", None), ("deltas", sinks.DELTAS)):
        table = f"{database}.{name}"
        sinks.create_table(spark, table, spark.range(1).select(F.col("id").alias("k"), "id").schema, options=options)
        sinks.append_with_serial(spark.range(0, 300_000, 1, 2).select((F.col("id") * 0).alias("id")), table, "k")
        assert spark.table(table).agg(F.countDistinct("k")).first()[0] == 300_000
        location[name] = size(spark, sinks._location(spark, table))
    assert 20 * location["deltas"] < location["plain"]


def test_repeated_times_are_counted_before_the_shuffle(spark, database, monkeypatch):
    monkeypatch.setattr(sinks, "STAMPS_TOGETHER", 8)
    monkeypatch.setattr(sinks, "STAMPS_PER_FILE", 100)
    table, n = f"{database}.times", 50
    stamps = spark.range(20 * n).select(
        F.when(F.col("id") % 20 != 0, F.timestamp_seconds(F.col("id") % 20)).alias("start_time")
    )
    stamps = stamps.unionByName(stamps.where("start_time = timestamp_seconds(7)").crossJoin(spark.range(9)).drop("id"))
    wanted = warehouse.time(stamps)
    sinks.create_table(spark, table, wanted.schema)
    sinks.truncate_load_times(stamps, warehouse.time, table, "start_time")
    got = spark.table(table)
    assert got.count() == 29 * n
    assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
    files = got.groupBy(F.input_file_name().alias("f")).agg(
        F.min("start_time").alias("a"), F.max("start_time").alias("b"), F.count("*").alias("n")
    ).where("a IS NOT NULL").orderBy("a", "b").collect()
    assert len(files) > 4 and all(x.b <= y.a for x, y in zip(files, files[1:]))
    # The hot stamp fills files of its own.
    assert max(f.n for f in files) < 9 * n


def test_empty_times(spark, database):
    stamps = spark.range(0).select(F.timestamp_seconds("id").alias("start_time"))
    table = f"{database}.none"
    sinks.create_table(spark, table, warehouse.time(stamps).schema)
    sinks.truncate_load_times(stamps, warehouse.time, table, "start_time")
    assert spark.table(table).count() == 0


def test_large_catalogs_give_plays_by_song(spark):
    events = spark.createDataFrame([("NextSong", "a", "s", 1, 0, 1, "free", 1, "l", "u")] * 2,
        "page string, artist string, song string, length long, ts long, user_id long, level string, session_id long, location string, user_agent string")
    catalog = spark.createDataFrame([("a", "s", 1, "S", "A")], "artist_name string, title string, duration long, song_id string, artist_id string")
    plan = warehouse.songplays(events, catalog)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_ids_are_counted_by_masks(spark):
    """64 ids that a task numbers are one shuffled row; any numbers are counted exactly."""
    values = [0, 1, 1, 63, 64, 131072, -1, -131072, 2**62, -(2**63), 2**63 - 1, None, None]
    ids = spark.createDataFrame([(v,) for v in values], "id long")
    assert tuple(id_counts(ids, "id", sinks.SERIAL_TASKS).first()) == (13, 10)
    assert tuple(id_counts(ids.limit(0), "id", sinks.SERIAL_TASKS).first()) == (0, 0)
    serials = spark.range(0, 64_000, 1, 2).select((F.col("id") % 32_000 * sinks.SERIAL_TASKS + F.spark_partition_id() + 1).alias("id"))
    assert tuple(id_counts(serials, "id", sinks.SERIAL_TASKS).first()) == (64_000, 64_000)
    masks = serials.groupBy(F.col("id").bitwiseAND(sinks.SERIAL_TASKS - 1), F.shiftright("id", 17 + 6)).count()
    assert masks.count() == 1_000


def test_a_play_gets_its_key_and_texts_before_its_matches(spark):
    """F2 to F11: they were made anew for each match of a play, which may have many."""
    events = spark.createDataFrame([("NextSong", "a", "s", 1, 1500, 1, "free", 7, "l", "u"), ("NextSong", "b", "s", 1, 1500, None, None, None, "l", "u")],
        "page string, artist string, song string, length long, ts long, userid int, level string, sessionid int, location string, useragent string")
    catalog = spark.createDataFrame([("a", "s", 1, f"S{i}", "A") for i in range(3)], "artist_name string, title string, duration long, song_id string, artist_id string")
    plays = incremental.songplays(events, catalog)
    above, below = plays._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)
    assert "md5(" in below and "md5(" not in above
    whole = plays.groupBy("playid").agg(F.countDistinct("song_id").alias("n")).orderBy("n").collect()
    key = spark.sql("SELECT md5(concat('7', cast(timestamp_seconds(1) AS string)))").first()[0]
    assert [tuple(r) for r in whole] == [(None, 0), (key, 3)]

    named = events.withColumnsRenamed({"userid": "user_id", "sessionid": "session_id", "useragent": "user_agent"})
    facts = warehouse.songplays(named, catalog)
    above, below = facts._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)
    assert "as string) AS session_id" in below and "as string) AS session_id" not in above
    assert sorted(r.session_id for r in facts.collect()) == ["7"] * 3


def test_times_of_few_files_are_written_by_many_tasks(spark, database, monkeypatch):
    """the times of 32 million plays were written by two tasks."""
    monkeypatch.setattr(sinks, "STAMPS_PER_TASK", 40, raising=False)
    stamps = spark.range(200).select(F.timestamp_seconds(F.col("id") % 90).alias("start_time"))
    table = f"{database}.spread"
    sinks.create_table(spark, table, warehouse.time(stamps).schema)
    sinks.truncate_load_times(stamps, warehouse.time, table, "start_time")
    files = spark.table(table).select(F.input_file_name()).distinct().count()
    assert 1 < min(spark.sparkContext.defaultParallelism, 5) == files
    assert spark.table(table).count() == 200
