import csv
import gzip
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starwright.schemas import schema
from starwright.sinks.tables import create_table
from starwright.sources.files import LOAD_ORDER, read_csv, read_json
from starwright.sources.staging import (
    coerce_to_schema,
    fields_from_jsonpaths,
    map_fields,
    stage_table,
)

AB = schema(a="long", b="text")


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(row) + "\n" for row in rows))


def test_recursive_and_glob_json(spark, tmp_path):
    lines(tmp_path / "x" / "1" / "one.json", [{"a": 1, "b": "p"}])
    lines(tmp_path / "x" / "2" / "two.json", [{"a": 2, "b": "q"}, {"b": None}])
    lines(tmp_path / "x" / "2" / "notes.txt", [{"a": 99}])
    got = read_json(spark, str(tmp_path / "x"), AB, recursive=True, partitions=3)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "p"), (2, "q"), (None, None)]
    assert got.rdd.getNumPartitions() == 3
    assert read_json(spark, f"{tmp_path}/x/*/*.json", AB).count() == 3
    assert read_json(spark, f"{tmp_path}/{{d}}/1", AB, params={"d": "x"}).count() == 1


def test_bad_json_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": 1}\n{"a": "x\n')
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        read_json(spark, str(tmp_path), AB).collect()


def test_load_order_follows_files_and_rows(spark, conf, tmp_path):
    conf(files__maxPartitionBytes="200", files__openCostInBytes="1")
    for f in range(3):
        lines(tmp_path / f"{f}.json", [{"a": f * 100 + i, "b": "x" * 20} for i in range(50)])
    got = read_json(spark, str(tmp_path), AB, with_load_order=True)
    assert got.rdd.getNumPartitions() > 3
    in_order = [row.a for row in got.orderBy(LOAD_ORDER).collect()]
    assert in_order == [f * 100 + i for f in range(3) for i in range(50)]


def write_csv_file(path, header_lines, rows):
    with open(path, "w", newline="") as file:
        for line in header_lines:
            file.write(line + "\n")
        csv.writer(file, quoting=csv.QUOTE_ALL).writerows(rows)


@pytest.mark.parametrize("headers", [0, 1, 3])
def test_csv_headers_are_skipped_in_every_file(spark, conf, tmp_path, headers):
    conf(files__maxPartitionBytes="300", files__openCostInBytes="1")
    expected = []
    for f in range(4):
        rows = [(f * 1000 + i, f'say "{i}", then go') for i in range(60)]
        write_csv_file(tmp_path / f"{f}.csv", [f"h{i},x" for i in range(headers)], rows)
        expected += rows
    got = read_csv(spark, str(tmp_path), AB, ignore_headers=headers)
    assert sorted(map(tuple, got.collect())) == expected


def test_csv_headers_across_small_batches(spark, conf, tmp_path):
    conf(execution__arrow__maxRecordsPerBatch="2")
    for f in range(3):
        write_csv_file(tmp_path / f"{f}.csv", ["x"] * 5, [(f, "v"), (f, "w")])
    with gzip.open(tmp_path / "z.csv.gz", "wt") as file:
        file.write("x\n" * 5 + "9,v\n")
    got = read_csv(spark, str(tmp_path), AB, ignore_headers=5)
    expected = [(f, v) for f in range(3) for v in "vw"] + [(9, "v")]
    assert sorted(map(tuple, got.collect())) == expected


def test_csv_delimiter_empty_fields_and_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("one|two\n1|\n|x\n")
    got = read_csv(spark, str(tmp_path), AB, delimiter="|")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None), (None, "x")]
    (tmp_path / "b.csv").write_text("one|two\nnot a number|x\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        read_csv(spark, str(tmp_path), AB, delimiter="|").collect()


def test_several_headers_exclude_multiline(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), AB, ignore_headers=2, multiline=True)


def test_coercion(spark):
    df = spark.createDataFrame(
        [(218.93, -80.7, "39", 1541106106796, "abcdef", "12.9"), (None, None, "", None, None, "")],
        "d double, e double, i string, ts long, s string, t string",
    )
    target = schema(d="number", e="number", i="int", ts="time", s="text", t="number")
    got = coerce_to_schema(df, target, {"s": 3})
    assert got.schema.simpleString() == (
        "struct<d:decimal(18,0),e:decimal(18,0),i:int,ts:timestamp,s:string,t:decimal(18,0)>"
    )
    first, second = got.withColumn("ts", F.col("ts").cast("string")).collect()
    assert (int(first.d), int(first.e), first.i, first.ts, first.s, int(first.t)) == (
        218, -80, 39, "2018-11-01 21:01:46.796", "abc", 12,
    )
    assert tuple(second) == (None,) * 6
    with pytest.raises(PySparkException):
        coerce_to_schema(spark.createDataFrame([("x",)], "i string"), schema(i="int")).collect()


def test_map_fields_orders_and_renames(spark):
    df = spark.createDataFrame([(1, (2,))], "x int, y struct<z:int>")
    got = map_fields(df, [("y.z", "second"), ("x", "first")])
    assert got.columns == ["second", "first"] and tuple(got.first()) == (2, 1)


def test_jsonpaths(spark):
    document = """{"jsonpaths": ["$.a.b", "$['c d']", "$[\\"e\\"]['f']"]}"""
    fields = fields_from_jsonpaths(document, ["x", "y", "z"])
    df = spark.sql("SELECT struct(1 AS b) AS a, 2 AS `c d`, struct(3 AS f) AS e")
    got = map_fields(df, fields)
    assert got.columns == ["x", "y", "z"] and tuple(got.first()) == (1, 2, 3)
    with pytest.raises(ValueError, match="3 paths for 2 columns"):
        fields_from_jsonpaths(document, ["x", "y"])
    with pytest.raises(ValueError, match="unsupported path"):
        fields_from_jsonpaths('{"jsonpaths": ["$.a[0]"]}', ["x"])


def test_stage_table(spark, database, tmp_path):
    table = f"{database}.staging"
    create_table(spark, table, schema(id="int", name="text", length="number"))
    lines(tmp_path / "json" / "a.json", [{"k": "7", "n": "abc", "l": 1.9}])
    source = schema(n="text", k="text", l="double")
    fields = [("k", "id"), ("n", "name"), ("l", "length")]
    for _ in range(2):
        stage_table(
            spark, table, f"{tmp_path}/{{kind}}", source,
            is_json=True, fields=fields, widths={"name": 2}, params={"kind": "json"},
        )
    assert [tuple(row) for row in spark.table(table).collect()] == [(7, "ab", 1)]
    (tmp_path / "a.csv").write_text("x;y;z\n8;def;2.9\n")
    stage_table(
        spark, table, f"{tmp_path}/a.csv", schema(x="text", y="text", z="text"),
        is_csv=True, delimiter=";",
    )
    assert [tuple(row) for row in spark.table(table).collect()] == [(8, "def", 2)]
    with pytest.raises(ValueError, match="is_json or is_csv"):
        stage_table(spark, table, str(tmp_path), source)
    assert spark.table(table).count() == 1


def test_only_named_placeholders_are_filled():
    from starwright.sources.files import rendered

    assert rendered("logs/{year}/{a,b}*.json", {"year": 2018}) == "logs/2018/{a,b}*.json"
    assert rendered("logs/{year}", None) == "logs/{year}"


def test_json_load_fills_absent_fields_with_null(spark, database, tmp_path):
    (tmp_path / "rows.json").write_text('{"a": 1}\n')
    table = f"{database}.auto"
    create_table(spark, table, schema(a="long", b="text", c="time"))
    stage_table(spark, table, str(tmp_path), schema(a="long"), is_json=True)
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, None, None)]
