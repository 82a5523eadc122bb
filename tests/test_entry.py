import __spark_entry__ as entry_points
from starwright.queries import REGISTRY


def test_entry_points_agree(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(REGISTRY) <= set(entry_points.oracle_sql())
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["l_orderkey", "l_linenumber", "song_id"]
    assert flagship.count() > 0
