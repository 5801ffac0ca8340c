"""Every contract query against its SQL, at the smallest scale."""

import pytest

from contract import ORACLE, QUERIES
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"

# Queries whose joins have a broadcast form and a shuffled form.
JOINING = [
    "pages_until_last", "pages_by_offset", "pages_by_cursor", "corrupt_file_skip", "file_layouts", "merge_update",
    "merge_partitions", "merge_nothing", "graph_dangling", "graph_valid_edges", "schema_drift", "header_drift",
]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert differences(spark, SF_DIR, QUERIES[name], ORACLE[name]) == []


@pytest.mark.parametrize("name", JOINING)
def test_query_without_broadcast(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(spark, SF_DIR, QUERIES[name], ORACLE[name]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_entry(spark):
    import __spark_entry__ as contract_entry

    rows = contract_entry.entry(spark).collect()
    assert {r["return_flag"] for r in rows} == {"A", "N", "R"}
