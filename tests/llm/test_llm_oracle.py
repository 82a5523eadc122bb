"""Queries that SQL expresses, and the shape of all."""

import pytest
from oracle import connect, differences

from corpus_pipeline import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(QUERIES) == sorted(
        [
            "op1_lm_scoring", "op2_language_id", "op3_token_counts", "op4_warc_revisits", "op5_embedding_dedup",
            "op6_decontamination", "op7_ngram_jaccard", "op8_quality", "op9_license_scan", "op10_bpe", "op11_merkle_manifest",
            "op12_filter_audit", "op13_line_dedup", "pipeline",
        ]
    )


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None
