import pytest

from starwright.operators.quality import non_empty_check, row_count_report
from starwright.schemas import schema
from starwright.sinks.tables import append, create_table


def test_missing_and_empty_tables_fail(spark, database):
    with pytest.raises(ValueError, match="does not exist"):
        non_empty_check(spark, f"{database}.missing")
    table = f"{database}.t"
    create_table(spark, table, schema(v="int"))
    with pytest.raises(ValueError, match="0 rows"):
        non_empty_check(spark, table)
    append(spark.createDataFrame([(1,), (2,)], "v int"), table)
    assert non_empty_check(spark, table) == 2


def test_report(spark):
    assert tuple(row_count_report(spark.range(3), "t").first()) == ("t", 3, True)
    assert tuple(row_count_report(spark.range(0), "t").first()) == ("t", 0, False)
