"""Ordered operators give the same answer whatever the shuffle partitioning (sf0.001)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
ORDERED = ["log_pages", "log_level_counts", "log_scan_depth", "ledger_append", "ledger_category",
           "ledger_get", "ledger_last_n", "peak_overlap", "pipe_prefix", "status_apply"]


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", ORDERED)
def test_same_result_for_1_3_17_partitions(spark, name):
    q = E.queries()[name]
    results = []
    try:
        for parts in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(rows(q(spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
