"""Plan checks over every registered query (sf0.001).

A ``SinglePartition`` exchange is only allowed above a sum without keys, a
bounded top-n or one row per numbering range, never over rows or groups.
Scans must be column-pruned.
"""

import os

import pytest

import __spark_entry__ as E
from tallyframe.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
SKIP = {"log_stream_counts"}  # returns a table that its stream wrote
#: What may stand below a single task: a sum without keys, a bounded top-n, or one row per range of the numbering.
BOUNDED = ("key=[]", "keys=[]", "Limit", "TakeOrdered", "keys=[__tf_range")


def subtree(lines, i):
    indent = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    out = []
    for line in lines[i + 1:]:
        d = len(line) - len(line.lstrip(" :+-"))
        if d <= indent:
            break
        out.append(line)
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_single_partition_over_raw_rows(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = subtree(lines, i)
            assert any(word in b for b in below[:4] for word in BOUNDED), (
                name, "\n".join(lines[i:i + 12]))


def test_check_catches_a_global_window_over_rows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(1000).withColumn("rn", F.row_number().over(Window.orderBy("id")))
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    hits = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert hits
    assert not any(any(word in b for b in subtree(lines, i)[:4] for word in BOUNDED) for i in hits)


def test_check_catches_a_window_over_all_groups(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(1000).groupBy("id").count().withColumn("rn", F.row_number().over(Window.orderBy("count")))
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    hits = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert hits and not any(word in b for i in hits for b in subtree(lines, i)[:4] for word in BOUNDED)


def _partial_before_exchange(plan: str, fn: str) -> bool:
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            if any(f"partial_{fn}" in b for b in subtree(lines, i)):
                return True
    return False


def test_hot_key_is_combined_map_side(spark):
    from pyspark.sql import functions as F

    from tallyframe.operators import changes as C
    from tallyframe.operators import ledger as L
    from tallyframe.operators import logs

    n = 30000
    # a third of all commands hit key 0
    cmds = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
                                 F.col("id").alias("seq"), (F.col("id") % 2 == 0).alias("is_borrowed"))
    cat = spark.range(0, n, 7).select(F.col("id").alias("key"), F.lit(False).alias("is_borrowed"))
    out = C.apply_status(cat, cmds)
    assert out.where("key = 0").first().is_borrowed == (max(i for i in range(n) if i % 3 == 0) % 2 == 0)
    assert _partial_before_exchange(out._jdf.queryExecution().executedPlan().toString(), "max_by")

    lg = spark.range(n).select(F.col("id").alias("pos"),
                               F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("txn_id"),
                               F.lit("t").alias("title"))
    firsts = L.first_by_id(lg)
    assert firsts.where("txn_id = 7").first().pos == 0
    assert _partial_before_exchange(firsts._jdf.queryExecution().executedPlan().toString(), "min_by")

    lines = spark.range(n).select(F.col("id").alias("pos"),
                                  F.when(F.col("id") % 3 == 0, F.lit("2026-06-11 10:00:00 ERROR x"))
                                  .otherwise(F.lit("2026-06-11 10:00:00 INFO y")).alias("value"))
    counts = logs.level_counts(logs.parse_lines(lines))
    assert {r.level: r.n for r in counts.collect()} == {"ERROR": n // 3, "INFO": n - n // 3}
    assert _partial_before_exchange(counts._jdf.queryExecution().executedPlan().toString(), "count")
