"""Response summaries and peak concurrency of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.numbering import _CELL, _PLACE, _RANGE, cell_range, in_cells
from tallyframe.session import shared_table


def response_summary(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Completed and successful (``status == 200``) counts, one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("completed"),
                  F.count_if(F.col(status_col) == 200).alias("successful"))


def peak_overlap(df: DataFrame, start: str = "start", end: str = "end",
                 buckets: int | None = None) -> DataFrame:
    """Largest number of half-open intervals ``[start, end)`` open at once.

    An interval without an end is still open; one without a start is not an
    interval and is left out.

    Sweep line without a global sort: one scan turns every interval into +1 at
    its start and -1 at its end; deltas are summed per distinct instant (a hot
    instant collapses map-side).  Instants are cut into cells; each gives its
    net change and its highest running sum, cells are added up inside their
    range, and the last step sees one row per range, a constant number.
    """
    intervals = df.where(F.col(start).isNotNull()).select(F.col(start).alias("t"), F.col(end).alias("end"))
    deltas = intervals.select(F.inline(F.array(
        F.struct(F.col("t"), F.lit(1).alias("d")), F.struct(F.col("end").alias("t"), F.lit(-1).alias("d"))))).where("t is not null")
    net = deltas.groupBy("t").agg(F.sum("d").cast("bigint").alias("d"))
    placed, _ = in_cells(shared_table(net, "instants"), [F.col("t").asc()], buckets)

    def add_up(rows: DataFrame, keys: list[str], within: Window) -> DataFrame:
        run = F.coalesce(F.sum("d").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("peak")
        return rows.withColumn("run", run).groupBy(*keys).agg(F.sum("d").alias("d"), F.max("run").alias("peak"))

    instants = placed.withColumn("peak", F.col("d"))
    by_cell = add_up(instants, [_CELL], Window.partitionBy(_CELL).orderBy(_PLACE))
    by_many = add_up(by_cell.select("*", cell_range()), [_RANGE], Window.partitionBy(_RANGE).orderBy(_CELL))
    whole = add_up(by_many, [], Window.orderBy(_RANGE))
    return whole.select(F.greatest(F.coalesce("peak", F.lit(0)), F.lit(0)).cast("bigint").alias("peak"))
