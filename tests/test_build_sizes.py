"""What builds write and keep: compressed text files, sources of their own, unsorted partition writes."""

from pyspark.sql import functions as F

from starwright import prepare
from starwright.operators.merges import keyed_last_write
from starwright.plans import lookups, reviews
from starwright.queries import registry, stars
from starwright.queries import reviews as review_queries
from starwright.schemas import ACTIVITY_LOG, SONG
from starwright.sinks import files as sinks
from starwright.sources.files import JSON_FILES, LOAD_ORDER, read_csv, read_json
from starwright.sources.ledger import listing
from starwright.storage import exists

FOLDER = "/root/testdata/sf0.001"


def size(spark, path):
    return listing(spark, path).where("path LIKE '%part-%'").agg(F.sum("size")).first()[0]


def names(spark, path):
    return sorted(r.path.rsplit("/", 1)[1] for r in listing(spark, path, JSON_FILES).collect())


def test_compressed_json_is_cut_into_files_and_read_with_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_TEXT_FILE", 30)
    rows = spark.range(100).coalesce(1)
    sinks.write_json(rows, f"{tmp_path}/in/packed", compression="gzip")
    sinks.write_json(spark.range(100, 103).coalesce(1), f"{tmp_path}/in/plain")
    assert [n.endswith(".json.gz") for n in names(spark, f"{tmp_path}/in")].count(True) == 4
    got = read_json(spark, f"{tmp_path}/in", rows.schema, recursive=True, with_load_order=True)
    assert sorted(r.id for r in got.collect()) == list(range(103))
    packed = got.where(F.col("id") < 100).select("id", F.col(LOAD_ORDER))
    assert [r.id for r in packed.orderBy(LOAD_ORDER).collect()] == list(range(100))


def test_sources_are_small_and_every_query_has_its_own(spark, tmp_path):
    """F3 to F9, F16, F20 to F22: text sources took many times the size of the tables."""
    t = registry.Tables(spark, FOLDER)
    with stars._sources(t) as (songs, log):
        assert all(n.endswith(".json.gz") for n in names(spark, log))
        rows = read_json(spark, log, ACTIVITY_LOG, recursive=True).select(*ACTIVITY_LOG.names)
        sinks.write_json(rows, f"{tmp_path}/plain")
        assert 5 * size(spark, log) < size(spark, f"{tmp_path}/plain")
        wanted = stars._log(t).select(*ACTIVITY_LOG.names)
        assert rows.exceptAll(wanted).count() == wanted.exceptAll(rows).count() == 0
        assert read_json(spark, songs, SONG, recursive=True).count() == t.part.count()
        with stars._sources(t) as (again, _):
            assert again != songs
        assert not exists(spark, again)
    assert not exists(spark, songs) and not exists(spark, log)


def test_csv_source_keeps_the_load_order(spark):
    t = registry.Tables(spark, FOLDER)
    order = ["ts", "sessionId", "itemInSession", F.col("userId").cast("long"), "song", "length"]
    with stars._csv(t) as path:
        log = read_csv(spark, path, stars.ACTIVITY_CSV, with_load_order=True)
        placed = [r[:6] for r in log.orderBy(LOAD_ORDER).select(*order).collect()]
        assert placed == [r[:6] for r in log.orderBy(*order).select(*order).collect()]
        assert len(placed) == t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
            t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
        ).count()


def test_text_outputs_of_builds_are_compressed(spark, tmp_path):
    t = registry.Tables(spark, FOLDER)
    with stars._csv(t) as path:
        lookups.build(spark, path, f"{tmp_path}/lookups")
    texts = listing(spark, f"{tmp_path}/lookups/events_csv").where("path LIKE '%part-%'").collect()
    assert texts and all(r.path.endswith(".csv.gz") for r in texts)
    with review_queries._sources(t) as source:
        reviews.build(spark, source, f"{tmp_path}/reviews", since=review_queries.SINCE, as_of_year=2024)
    facts = names(spark, f"{tmp_path}/reviews/business_reviews.json")
    assert facts and all(n.endswith(".json.gz") for n in facts)


def test_partitions_are_written_without_a_sort(spark, tmp_path):
    """the sort before a partitioned write held a task's whole share of the rows."""
    prepare(spark)
    partitions = 3
    rows = spark.range(30).withColumn("p", F.col("id") % partitions)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > partitions
    sinks.write_parquet(rows, f"{tmp_path}/out", partition_by=["p"])
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.id, r.p) for r in back.collect()) == [(i, i % partitions) for i in range(30)]


def test_last_write_of_a_log_read_from_compressed_files(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "k long, v string, o long")
    sinks.write_json(frame.coalesce(1).sortWithinPartitions("o"), f"{tmp_path}/in", compression="gzip")
    read = read_json(spark, f"{tmp_path}/in", frame.schema, recursive=True, with_load_order=True)
    last = keyed_last_write(read, ["k"], [LOAD_ORDER], ["k", "v"])
    assert sorted(map(tuple, last.collect())) == [(1, "b"), (2, "c")]
