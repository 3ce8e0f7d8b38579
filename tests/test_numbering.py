"""Global numbering: same numbers for any partitioning, no single-partition exchange over rows."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import numbering as N
from tallyframe.operators.numbering import assign_ids, collect_pages, paginate, with_row_number


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3, 17])
@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_row_number_partition_invariant(spark, parts, buckets):
    df = spark.range(0, 5000, 1, parts).select((F.col("id") * 7 % 5003).alias("pos"))
    got = with_row_number(df, "pos", "rn", buckets).orderBy("pos").collect()
    expect = sorted(r.pos for r in df.collect())
    assert [r.pos for r in got] == expect
    assert [r.rn for r in got] == list(range(1, 5001))


def test_row_number_skewed_key_distribution(spark):
    # a third of the keys packed into a tiny range: quantile buckets still split them
    dense = spark.range(0, 3000).select((F.col("id") + 10**9).alias("pos"))
    sparse = spark.range(0, 6000).select((F.col("id") * 1000).alias("pos"))
    df = dense.unionByName(sparse)
    got = with_row_number(df, "pos", "rn", 8)
    sizes = got.groupBy(F.floor((F.col("rn") - 1) / 1125)).count().collect()
    assert sum(r[1] for r in sizes) == 9000
    assert [r.rn for r in got.orderBy("pos").collect()] == list(range(1, 9001))


def test_no_single_partition_exchange_over_rows(spark):
    df = spark.range(0, 1000, 1, 4).select(F.col("id").alias("pos"), F.lit("x").alias("payload"))
    numbered = with_row_number(df, "pos", "rn", 4)
    plan = plan_text(numbered)
    # the only SinglePartition exchange allowed is over the per-bucket counts
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "payload" not in line
    numbered.collect()


def test_dates_and_timestamps_as_keys(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-03-01')) AS d")
    got = with_row_number(df, "d", "rn", 5).orderBy("d").collect()
    assert [r.rn for r in got] == list(range(1, len(got) + 1))
    ts = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2020-03-08 00:00', TIMESTAMP_NTZ'2020-03-08 05:00', "
                   "INTERVAL 7 MINUTES)) AS t")
    got = with_row_number(ts, "t", "rn", 5).orderBy("t").collect()
    assert [r.rn for r in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("n,size,pages,last", [(0, 5, 0, None), (10, 5, 2, 5), (12, 5, 3, 2), (3, 5, 1, 3),
                                               (7, 1, 7, 1)])
def test_page_edges(spark, n, size, pages, last):
    df = spark.range(0, n, 1, 3).select(F.col("id").alias("pos"))
    paged = collect_pages(paginate(df, "pos", size, buckets=3)).orderBy("page_no").collect()
    assert len(paged) == pages
    if pages:
        assert paged[-1].n_rows == last
        flat = [r.pos for p in paged for r in p.rows]
        assert flat == list(range(n))


def test_page_size_zero_gives_no_pages(spark):
    df = spark.range(10).select(F.col("id").alias("pos"))
    assert paginate(df, "pos", 0).count() == 0


def test_assign_ids_continue_from_base(spark):
    batch = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "pos long, title string")
    got = assign_ids(batch, "pos", 8).orderBy("pos").collect()
    assert [(r.title, r.txn_id) for r in got] == [("a", 8), ("b", 9), ("c", 10)]


KEYS = {"exponential": "cast(exp(id / 1500.0) as bigint) * 100000 + id", "power": "id * id * id * id", "a third of one value": "case when id % 3 = 0 then 7 else id end",
        "0.3 % of one value": "case when id % 300 = 0 then 7 else id end", "all of one value": "7"}


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("descending", [False, True])
def test_cells_follow_the_data(spark, monkeypatch, name, descending):
    monkeypatch.setattr(N, "CELL_ROWS", 300)
    df = spark.range(0, 30000, 1, 4).select(F.expr(KEYS[name]).alias("n"), (F.col("id") * 7 % 30011).alias("seen"))
    order = [F.col("n").desc() if descending else F.col("n").asc(), F.col("seen").asc()]
    placed, cells = N.in_cells(df, order)
    sizes = placed.groupBy(N._CELL).count()
    assert cells == 100 and sizes.agg(F.max("count")).first()[0] <= 4 * N.CELL_ROWS
    got = sorted(N.with_row_number(df, "n", "rn", descending=descending, tie_cols=("seen",)).collect(), key=lambda r: r.rn)
    assert [r.rn for r in got] == list(range(1, 30001))
    assert [(r.n, r.seen) for r in got] == sorted(((r.n, r.seen) for r in got), key=lambda t: (-t[0] if descending else t[0], t[1]))


def test_texts_with_a_long_common_beginning(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 300)
    names = spark.range(0, 20000, 1, 4).select(F.concat(F.lit("the same twenty-two by "), F.lpad((F.col("id") * 7 % 20011).cast("string"), 9, "0")).alias("name"))
    placed, cells = N.in_cells(names, [F.col("name").asc()])
    sizes = placed.groupBy(N._CELL).count()
    assert sizes.count() > cells // 2 and sizes.agg(F.max("count")).first()[0] <= 4 * N.CELL_ROWS
    got = sorted(N.rank_text(names, "name", "at").collect(), key=lambda r: r["at"])
    assert [r.name for r in got] == sorted(r.name for r in got) and [r["at"] for r in got] == list(range(20000))


def test_texts_in_code_point_order_and_nulls(spark):
    names = ["b", "a", "", "é", "z", "\uffff", "😀", "a b", "A", None]
    got = N.rank_text(spark.createDataFrame([(n,) for n in names], "name string"), "name", "at").where("name <> ''").orderBy("at").collect()
    assert [r.name for r in got] == sorted(n for n in names if n)


@pytest.mark.parametrize("shuffles", ["1", "17", "2000"])
def test_plan_does_not_follow_the_shuffle_partitions(spark, shuffles):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    try:
        df = spark.range(0, 3000).select((F.col("id") * 5).alias("pos"))
        assert N.in_cells(df, [F.col("pos").asc()])[1] == 1
        assert [r.rn for r in N.with_row_number(df, "pos").orderBy("pos").collect()] == list(range(1, 3001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranking_many_tied_groups(spark):
    groups = spark.range(0, 20000).select(F.col("id").alias("g"), F.lit(1).alias("n"), (F.col("id") * 11 % 20011).alias("first_pos"))
    got = N.rank_desc(groups, "n", "first_pos").orderBy("first_pos").collect()
    assert [r["rank"] for r in got] == list(range(1, 20001))
