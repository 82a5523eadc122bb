"""Sort keys, serial blocks, column widths and ids that stay."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starwright.operators.dimensions import dimension_with_id, new_surrogates
from starwright.plans import warehouse
from starwright.schemas import WAREHOUSE_EVENTS, WAREHOUSE_STAR, schema
from starwright.sinks import tables
from starwright.sinks.files import laid_out, write_parquet
from starwright.sinks.tables import append, append_with_serial, create_table, truncate_load


def ranges(spark, path, column):
    rows = spark.read.parquet(path).withColumn("file", F.input_file_name()).groupBy("file")
    return sorted((r.low, r.high) for r in rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).collect())


def test_files_of_a_sort_key_do_not_overlap(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="32KB", adaptive__coalescePartitions__minPartitionSize="16KB")
    df = spark.range(0, 100_000, 1, 8).select((F.xxhash64("id") % 5000).alias("k"), F.col("id").alias("v"))
    write_parquet(df, f"{tmp_path}/out", range_by=["k"], sort_by=["v"])
    found = ranges(spark, f"{tmp_path}/out", "k")
    assert len(found) >= 4 and all(high <= low for (_, high), (low, _) in zip(found, found[1:]))
    some = spark.read.parquet(f"{tmp_path}/out").filter("k BETWEEN 100 AND 200").withColumn("file", F.input_file_name())
    assert some.select("file").distinct().count() <= 2
    for file in spark.read.parquet(f"{tmp_path}/out").inputFiles()[:3]:
        rows = [tuple(r) for r in spark.read.parquet(file).coalesce(1).collect()]
        assert rows == sorted(rows)


def test_a_hot_sort_key_fills_several_files(spark, conf, tmp_path):
    conf(adaptive__enabled="false")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    df = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
    write_parquet(df, f"{tmp_path}/out", range_by=["k"])
    found = ranges(spark, f"{tmp_path}/out", "k")
    assert sum(low == high == 7 for low, high in found) >= 1
    sizes = spark.read.parquet(f"{tmp_path}/out").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 20_000


def test_a_range_of_a_loaded_table_skips_files(spark, conf, database):
    conf(adaptive__enabled="false")
    table = f"{database}.t"
    create_table(spark, table, schema(day="int", v="long"))
    truncate_load(spark.range(80_000).select((F.col("id") % 400).cast("int"), "id"), table, sort_key=["day"])
    append(spark.range(80_000).select((F.col("id") % 400 + 400).cast("int"), "id"), table, sort_key=["day"])
    path = spark.table(table).inputFiles()[0].rsplit("/", 1)[0]
    found = ranges(spark, path, "day")
    assert len(found) >= 8 and all(high <= low for (_, high), (low, _) in zip(found, found[1:]))
    inside = [x for x in found if x[1] >= 500 and x[0] <= 520]
    assert len(inside) <= 2


def test_ranges_go_with_no_other_layout(spark):
    df = spark.range(3)
    for other in ({"partition_by": ["id"]}, {"cluster_by": ["id"]}, {"max_files": 2}):
        with pytest.raises(ValueError, match="ranges exclude"):
            laid_out(df, range_by=["id"], **other)


@pytest.fixture
def numbered_table(spark, database):
    table = f"{database}.numbered"
    create_table(spark, table, schema(id="long", v="long"))
    return table


def serial(spark, table):
    return int(tables.properties(spark, table)[tables.SERIAL_PROPERTY])


@pytest.mark.parametrize("gapless", [False, True])
def test_serial_numbers_go_on(spark, numbered_table, gapless):
    last = 0
    for size in (500, 0, 300, 1):
        append_with_serial(spark.range(size).select(F.col("id").alias("v")), numbered_table, "id", gapless=gapless)
        ids = sorted(r.id for r in spark.table(numbered_table).collect())
        assert len(set(ids)) == len(ids)
        if size:
            assert sum(i > last for i in ids) == size
            last = ids[-1]
        assert serial(spark, numbered_table) == last + 1
    if gapless:
        assert ids == list(range(1, 802))


def test_serial_blocks_take_one_write_and_no_scan(spark, numbered_table, monkeypatch):
    append_with_serial(spark.range(10), numbered_table, "id")
    monkeypatch.setattr(tables, "numbered", None)  # what counts and writes rows first
    read = []
    table = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: read.append(name) or table(self, name))
    aggregated = []
    monkeypatch.setattr(type(spark.range(1)), "agg", lambda self, *a: aggregated.append(a))
    append_with_serial(spark.range(10), numbered_table, "id")
    assert not aggregated and read == [numbered_table]  # for its schema
    monkeypatch.undo()
    assert spark.table(numbered_table).select("id").distinct().count() == 20


def test_serials_of_appends_at_the_same_time_differ(spark, numbered_table, monkeypatch):
    """A second append begins after the first has reserved its ids, and ends before it."""
    add = tables.append

    def meanwhile(rows, table):
        monkeypatch.setattr(tables, "append", add)
        append_with_serial(spark.range(50).select(F.col("id").alias("v")), table, "id")
        add(rows, table)

    monkeypatch.setattr(tables, "append", meanwhile)
    append_with_serial(spark.range(50).select(F.col("id").alias("v")), numbered_table, "id")
    append_with_serial(spark.range(50).select(F.col("id").alias("v")), numbered_table, "id")
    assert spark.table(numbered_table).select("id").distinct().count() == 150


def test_serials_go_on_in_a_table_that_was_numbered_before(spark, numbered_table):
    append(spark.createDataFrame([(41, 0)], "id long, v long"), numbered_table)
    append_with_serial(spark.range(1), numbered_table, "id", gapless=True)
    assert sorted(r.id for r in spark.table(numbered_table).collect()) == [41, 42]


def event(spark, **values):
    row = {f.name: None for f in WAREHOUSE_EVENTS} | values
    casts = [F.lit(row[f.name]).cast(f.dataType if "char" not in f.dataType.simpleString() else "string").alias(f.name) for f in WAREHOUSE_EVENTS]
    return spark.range(1).select(*casts)


def test_texts_longer_than_their_column_fail_the_load(spark, database):
    table = f"{database}.staging_events"
    create_table(spark, table, WAREHOUSE_EVENTS)
    append(event(spark, song="t" * 256, gender="F"), table)
    append(event(spark, song="é" * 256, gender=None), table)
    for wrong in ({"song": "t" * 257}, {"gender": "FF"}):
        with pytest.raises(PySparkException, match="(?i)exceed"):
            append(event(spark, **wrong), table)
    assert spark.table(table).count() == 2
    songs = f"{database}.songs"
    create_table(spark, songs, WAREHOUSE_STAR["songs"])
    with pytest.raises(PySparkException, match="(?i)exceed"):
        truncate_load(spark.range(1).select(F.lit("S"), F.lit("t" * 300), F.lit("A"), F.lit(1), F.lit(2)), songs)


def test_a_long_title_fails_the_build_or_is_cut(spark, database, tmp_path):
    import json

    title = "x" * 300
    (tmp_path / "songs").mkdir()
    (tmp_path / "log").mkdir()
    song = {"song_id": "S", "title": title, "artist_id": "A", "artist_name": "Ann", "duration": 5.0, "year": 2000}
    (tmp_path / "songs" / "a.json").write_text(json.dumps(song) + "\n")
    play = {"artist": "Ann", "song": title, "length": 5.5, "page": "NextSong", "userId": "1", "ts": 1_700_000_000_000, "sessionId": 3, "gender": "F"}
    (tmp_path / "log" / "a.json").write_text(json.dumps(play) + "\n")
    paths = (str(tmp_path / "songs"), str(tmp_path / "log"))
    with pytest.raises(PySparkException, match="(?i)exceed"):
        warehouse.build(spark, database, *paths)
    tables = warehouse.build(spark, database, *paths, text_width=256)
    assert tables["songplays"].count() == 1 and tables["songs"].first().title == "x" * 256


def test_new_values_get_the_next_ids(spark):
    before = spark.createDataFrame([("b",), ("d",), ("b",), (None,)], "value string")
    stored = dimension_with_id(before, "value", "value_id")
    now = spark.createDataFrame([("a",), ("d",), ("e",), (None,), ("c",), ("a",)], "value string")
    added = new_surrogates(stored, now, "value", "value_id")
    assert sorted((r.value_id, r.value) for r in added.collect()) == [(3, "a"), (4, "c"), (5, "e")]
    assert new_surrogates(stored.unionByName(added), now, "value", "value_id").count() == 0
    empty = stored.filter("false")
    assert sorted((r.value_id, r.value) for r in new_surrogates(empty, before, "value", "value_id").collect()) == [(1, "b"), (2, "d")]


def test_interval_tables_check_their_widths(spark, database):
    from starwright.schemas import INCREMENTAL_STAR

    table = f"{database}.songplays"
    create_table(spark, table, INCREMENTAL_STAR["songplays"])
    row = spark.range(1).select(F.lit("k" * 33), F.lit(date(2024, 1, 1)).cast("timestamp"), *[F.lit(None).cast("string")] * 7)
    with pytest.raises(PySparkException, match="(?i)exceed"):
        append(row, table)
