"""Ledger reports as DataFrames: summary, category breakdown, monthly, TOTAL rows.

Group sizes never matter here: every report is a partial + final hash
aggregate.  Ranks and the grand total are computed over the grouped rows
(one per category or month), and the grand total for shares is a scalar
subquery, not a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.exact import avg_half_even, share_half_even
from tallyframe.operators.numbering import rank_desc
from tallyframe.session import shared_table


def _zero():
    return F.lit(0).cast("decimal(38,2)")


def summary(df: DataFrame) -> DataFrame:
    """Count, total, half-even average, earliest and latest date (one row)."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("amount"), _zero()).alias("total"),
                 F.min("date").alias("earliest"), F.max("date").alias("latest"))
    return agg.withColumn(
        "average", F.when(F.col("n") > 0, avg_half_even(F.col("total"), F.col("n"))))


def category_breakdown(df: DataFrame) -> DataFrame:
    """Per exact category: count, total, share of grand total (half-even 0.1),
    rank by total descending with ties in first-seen order."""
    grouped = shared_table(df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.min("pos").alias("first_pos")), "categories")
    grand = grouped.agg(F.sum("total").cast("decimal(38,2)")).scalar()  # of the groups: the ledger is read once
    # the grand total is bound to a column once: every reference to a scalar
    # subquery would otherwise run it again
    shared = grouped.withColumn("__grand", grand).withColumn(
        "share", share_half_even(F.col("total"), F.col("__grand"))).drop("__grand")
    return rank_desc(shared, "total", "first_pos")


def monthly(df: DataFrame) -> DataFrame:
    """Per calendar month ``YYYY-MM``: count and total (the key sorts oldest first)."""
    return df.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))


def category_rollup(df: DataFrame) -> DataFrame:
    """Category rows plus a TOTAL row (``is_total``), one rollup aggregate."""
    r = df.rollup("category").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"),
                                  F.grouping("category").alias("g"))
    return r.select(F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col("category")).alias("label"),
                    (F.col("g") == 1).alias("is_total"), "n", "total")


def monthly_rollup(df: DataFrame) -> DataFrame:
    """Month rows plus a TOTAL row."""
    m = df.withColumn("month", F.date_format("date", "yyyy-MM"))
    r = m.rollup("month").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"),
                              F.grouping("month").alias("g"))
    return r.select(F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col("month")).alias("label"),
                    (F.col("g") == 1).alias("is_total"), "n", "total")


def summary_report(df: DataFrame) -> DataFrame:
    """``summary`` as a report: no row for an empty ledger."""
    return summary(df).where("n > 0")


REPORTS = {
    "summary": summary_report,
    "category": category_breakdown,
    "monthly": monthly,
}


def get_report(name: str):
    """Report function by name; unknown names raise ``KeyError``."""
    return REPORTS[name]
