import csv
from pathlib import Path

from pyspark.sql import functions as F

from starwright.schemas import schema
from starwright.sinks.files import write_csv, write_json, write_parquet
from starwright.sources.files import read_csv, read_json


def files(path, suffix):
    return sorted(Path(path).rglob(f"*{suffix}"))


def test_partitioned_parquet_is_overwritten(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("year"))
    path = f"{tmp_path}/out"
    for _ in range(2):
        write_parquet(df, path, partition_by=["year"])
    back = spark.read.parquet(path)
    assert back.columns == ["id", "year"] and back.count() == 100
    assert len(files(path, ".parquet")) == 4  # rows of a value come together
    plan = back.filter("year = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_partition_columns_can_stay_in_the_files(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("year"))
    write_json(df, f"{tmp_path}/out", partition_by=["year"], keep_partition_columns=True)
    assert {p.parent.name for p in files(f"{tmp_path}/out", ".json")} == {"yearp=0", "yearp=1"}
    back = read_json(spark, f"{tmp_path}/out", schema(id="long", year="int")).select("id", "year")
    assert sorted(map(tuple, back.collect())) == [(i, i % 2) for i in range(10)]


def test_bounded_number_of_files(spark, tmp_path):
    write_parquet(spark.range(0, 1000, 1, 16), f"{tmp_path}/out", max_files=5)
    assert len(files(f"{tmp_path}/out", ".parquet")) == 5
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1000


def test_clustered_files_are_sorted_and_a_hot_value_is_split(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="16KB")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int")
    df = spark.range(0, 100_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
    write_parquet(df, f"{tmp_path}/out", cluster_by=["k"], sort_by=["v"])
    back = spark.read.parquet(f"{tmp_path}/out").withColumn("file", F.input_file_name())
    assert back.count() == 100_000
    assert back.filter("k = 7").select("file").distinct().count() > 1
    for path in files(f"{tmp_path}/out", ".parquet")[:3]:
        rows = [tuple(row) for row in spark.read.parquet(str(path)).coalesce(1).collect()]
        assert rows == sorted(rows)


def test_csv_is_fully_quoted(spark, tmp_path):
    rows = [("a,b", 'say "hi"', 1), ("line\nend", "", 2)]
    df = spark.createDataFrame(rows, "x string, y string, z int")
    write_csv(df, f"{tmp_path}/out", columns=["y", "x"], max_files=1)
    (path,) = files(f"{tmp_path}/out", ".csv")
    assert path.read_text().startswith('"y","x"\n')
    with open(path, newline="") as file:
        parsed = list(csv.reader(file))
    assert sorted(parsed[1:]) == [["", "line\nend"], ['say "hi"', "a,b"]]
    back = read_csv(spark, f"{tmp_path}/out", schema(y="text", x="text"), multiline=True)
    assert back.filter("x = 'line\nend'").count() == 1
