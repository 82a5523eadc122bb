"""Merge targets: batches touch the buckets of their own keys, ledgers answer for the target."""

from random import Random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starwright.schemas import schema
from starwright.sinks import merge_targets
from starwright.sinks.merge_targets import BUCKET, MergeTarget, contents, create_merge_table, ledger_name
from starwright.sinks.tables import drop_table, upsert_ignore, upsert_update

COLUMNS = schema(id="int", name="text", level="text")
BATCH = "id int, name string, level string, at int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(spark, table):
    return {f.name: f.bucket for f in spark.table(table).select(F.input_file_name().alias("name"), F.col(BUCKET).alias("bucket")).distinct().collect()}


def people(spark, ids, at=0, level="free"):
    return spark.createDataFrame([(i, f"n{i}", level, at + i) for i in ids], BATCH)


@pytest.fixture
def target(spark, database):
    def make(ledger=True, buckets=32, keys=("id",), **options):
        table = f"{database}.people"
        create_merge_table(spark, table, COLUMNS, keys, buckets=buckets, ledger=ledger, **options)
        return table

    return make


@pytest.mark.parametrize("ledger", [True, False])
def test_an_update_leaves_the_files_of_other_buckets(spark, target, ledger):
    table = target(ledger)
    upsert_update(people(spark, range(2000)), table, ["id"], ["at"], ["level"])
    before = files(spark, table)
    assert len(set(before.values())) == 32
    few = people(spark, [*range(0, 40, 8), *range(5000, 5005)], 9000, "paid")
    touched = MergeTarget(spark, table).touched(few)
    upsert_update(few, table, ["id"], ["at"], ["level"])
    after = files(spark, table)
    untouched = {name for name, bucket in before.items() if bucket not in touched}
    assert untouched and untouched <= set(after)
    assert not {name for name, bucket in before.items() if bucket in touched} & set(after)
    changed = contents(spark, table).where("level = 'paid'")
    assert sorted(r.id for r in changed.collect()) == [0, 8, 16, 24, 32, *range(5000, 5005)]
    assert contents(spark, table).count() == 2005
    if ledger:
        assert spark.table(ledger_name(table)).count() == 2005


def test_an_insert_reads_the_hashes_of_its_buckets_only(spark, target, conf):
    conf(debug__maxToStringFields="100", maxMetadataStringLength="5000")
    table = target()
    upsert_ignore(people(spark, range(2000)), table, ["id"], ["at"])
    merge = MergeTarget(spark, table)
    few = people(spark, [3, 4, 9000])
    plan = merge.unknown(few, merge.touched(few))._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    assert ledger_name("people") in scan and f"PartitionFilters: [{BUCKET}#" in scan and " IN (" in scan
    assert "ReadSchema: struct<h1:bigint,h2:bigint>" in scan
    before = files(spark, table)
    upsert_ignore(people(spark, [3, 4, 9000], level="x"), table, ["id"], ["at"])
    after = files(spark, table)
    assert set(before) < set(after) and len(after) == len(before) + 1
    assert contents(spark, table).where("level = 'x'").count() == 1


def test_files_read_by_an_insert_do_not_grow_with_the_target(spark, target):
    table = target(buckets=16)
    read = []
    for size in (200, 2000, 20000):
        upsert_ignore(people(spark, range(size)), table, ["id"], ["at"])
        merge = MergeTarget(spark, table)
        few = people(spark, [1])
        read.append(len(merge._of(ledger_name(table), merge.touched(few)).inputFiles()))
    assert read == [1, 2, 3]  # one for each batch before, whatever its size


def test_a_run_lost_between_target_and_ledger_is_made_good(spark, target, monkeypatch):
    table = target()
    upsert_ignore(people(spark, range(50)), table, ["id"], ["at"])
    with monkeypatch.context() as lost:
        lost.setattr(MergeTarget, "_note", lambda self, rows: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            upsert_ignore(people(spark, range(100)), table, ["id"], ["at"])
    upsert_ignore(people(spark, range(120)), table, ["id"], ["at"])
    assert sorted(r.id for r in contents(spark, table).collect()) == list(range(120))
    assert spark.table(ledger_name(table)).count() == 120


def test_keys_hash_alike_whatever_type_a_batch_has(spark, target):
    table = target()
    upsert_ignore(people(spark, range(20)), table, ["id"], ["at"])
    wide = people(spark, range(25)).withColumn("id", F.col("id").cast("long"))
    upsert_ignore(wide, table, ["id"], ["at"])
    upsert_update(wide.withColumn("level", F.lit("paid")), table, ["id"], ["at"], ["level"])
    assert contents(spark, table).where("level = 'paid'").count() == 25


def test_rows_merged_as_a_set_with_nulls(spark, target):
    table = target(keys=COLUMNS.names, null_keys=True)
    first = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "x", None), (None, None, None)], COLUMNS)
    second = spark.createDataFrame([(1, "x", None), (None, "x", None), (1, None, "x"), (None, None, "x")], COLUMNS)
    for batch in (first, second, second):
        upsert_ignore(batch, table, COLUMNS.names, [])
    assert rows(contents(spark, table)) == rows(first.union(second).distinct())
    with pytest.raises(ValueError, match="without nulls"):
        upsert_update(first, table, COLUMNS.names, [], [])


def test_null_keys_other_keys_and_plain_tables_are_refused(spark, target, database):
    table = target()
    with pytest.raises(PySparkException, match="null in key column id"):
        upsert_ignore(spark.createDataFrame([(None, "a", "x", 1)], BATCH), table, ["id"], ["at"])
    with pytest.raises(ValueError, match="merges by"):
        upsert_ignore(people(spark, [1]), table, ["name"], ["at"])
    with pytest.raises(ValueError, match="only a ledger"):
        target(ledger=False, null_keys=True)
    spark.sql(f"CREATE TABLE {database}.plain (id INT) USING parquet")
    with pytest.raises(ValueError, match="no merge target"):
        MergeTarget(spark, f"{database}.plain")
    upsert_update(people(spark, []), table, ["id"], ["at"], ["level"])
    upsert_ignore(people(spark, []), table, ["id"], ["at"])
    assert contents(spark, table).count() == 0
    drop_table(spark, table)
    assert not spark.catalog.tableExists(ledger_name(table))


def test_compaction_keeps_rows_and_lowers_files(spark, target):
    table = target(buckets=2)
    for i in range(4):
        upsert_ignore(people(spark, range(20 * i, 20 * i + 20)), table, ["id"], ["at"])
    before = rows(contents(spark, table))
    assert len(files(spark, table)) == 8
    MergeTarget(spark, table).compact()
    assert len(files(spark, table)) == 2 and rows(contents(spark, table)) == before


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_against_row_by_row_upserts(spark, target, seed):
    """Updates and inserts in turn on one target with a ledger, a third of all rows under one key."""
    random, table, expected = Random(seed), target(buckets=8), {}
    for kind in ("update", "ignore", "update", "ignore"):
        batch = [
            (0 if random.random() < 0.33 else random.randrange(300), random.choice(["a", "b", None]), random.choice(["x", "y", None]), at)
            for at in random.sample(range(10**6), 400)
        ]
        for key, name, level, _ in sorted(batch, key=lambda row: row[3]):
            if kind == "ignore":
                expected.setdefault(key, (name, level))
            else:
                expected[key] = (expected[key][0] if key in expected else name, level)
        df = spark.createDataFrame(batch, BATCH).repartition(5)
        if kind == "ignore":
            upsert_ignore(df, table, ["id"], ["at"])
        else:
            upsert_update(df, table, ["id"], ["at"], ["level"])
    assert {r.id: (r.name, r.level) for r in contents(spark, table).collect()} == expected
    assert spark.table(ledger_name(table)).count() == len(expected)
    assert merge_targets.properties(spark, table)[merge_targets.LEDGER_PROPERTY] == "yes"
