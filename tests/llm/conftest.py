import pytest
from pyspark.sql import types as T

from starwright.llm.common import prepare

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def docs(spark):
    """A frame of (doc_id, text) rows."""
    prepare(spark)
    return lambda rows: spark.createDataFrame([tuple(r) for r in rows], DOCS)
