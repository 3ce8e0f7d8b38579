"""Global row numbers, pages and id assignment without a one-partition window.

``row_number() OVER (ORDER BY pos)`` with no partition moves every row into a
single task.  Instead the rows are dealt into cells, ranges of the whole order
(key and tie columns together, of any type) whose ends Spark samples from the
data, as many as the rows need.  Each cell is sorted and written once with every
row's place in it; a row's number is its place plus the rows of the cells before.
A value that a third of the rows share is cut by the tie columns like any other
stretch of the order, and so are texts with a long common beginning.

The order key (with its tie columns) must be unique, or any numbering is
ambiguous.  Numbers are read from the written cells, so a stage that is run again
after a lost executor gives the same ones, and the sampled ends only balance:
they never change the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import shared_table

_CELL = "__tf_cell"
_RANGE = "__tf_range"
_PLACE = "__tf_place"
_OFFSET = "__tf_offset"

#: Rows that a cell should hold; cells whose offsets (16 bytes each) are sent to all executors, beyond them they are joined by a shuffle.
CELL_ROWS, MOST_BROADCAST_CELLS = 1_000_000, 1_000_000
#: Cells are added up in ranges of 2 to this power, about four thousand million rows each.
RANGE_BITS = 12


def cell_range() -> Column:
    return F.shiftright(_CELL, RANGE_BITS).alias(_RANGE)


def in_cells(df: DataFrame, order: list[Column], cells: int | None = None) -> tuple[DataFrame, int]:
    """The rows written in cells, and how many cells were asked for.

    Adds the cell and the place (from 0) of every row; cells and places ascend
    with the order.
    """
    if cells is None:
        cells = max(1, -(-df.count() // CELL_ROWS))
    at = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(cells, *order).sortWithinPartitions(*order).withColumn("__tf_at", at)
    placed = dealt.withColumns({_CELL: F.shiftright("__tf_at", 33), _PLACE: F.col("__tf_at").bitwiseAND((1 << 33) - 1)}).drop("__tf_at")
    return shared_table(placed, "cells"), cells


def with_row_number(df: DataFrame, order_col: str, out: str = "rn",
                    buckets: int | None = None, descending: bool = False,
                    tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """Add a 1-based ``bigint`` row number in ``order_col`` order (ascending
    unless ``descending``), ties broken by ``tie_cols`` ascending.

    Null keys come first in an ascending order and last in a descending one.
    ``buckets`` sets the number of cells.  Cost: the rows are counted, the order
    is sampled, and the rows are shuffled and written once.
    """
    order = [F.col(order_col).desc() if descending else F.col(order_col).asc(), *[F.col(c).asc() for c in tie_cols]]
    placed, cells = in_cells(df, order, buckets)
    sizes = placed.groupBy(cell_range(), _CELL).agg(F.count(F.lit(1)).alias("__tf_count"))

    def before(keys: Window) -> Column:
        return F.coalesce(F.sum("__tf_count").over(keys.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    ranges = sizes.groupBy(_RANGE).agg(F.sum("__tf_count").alias("__tf_count")).select(F.col(_RANGE).alias("__tf_of"), before(Window.orderBy(_RANGE)).alias("__tf_base"))
    inside = sizes.select(_RANGE, _CELL, before(Window.partitionBy(_RANGE).orderBy(_CELL)).alias("__tf_inside"))
    offsets = inside.join(ranges, F.col(_RANGE) == F.col("__tf_of")).select(_CELL, (F.col("__tf_base") + F.col("__tf_inside")).alias(_OFFSET))
    if cells <= MOST_BROADCAST_CELLS:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, _CELL).withColumn(out, (F.col(_OFFSET) + F.col(_PLACE) + 1).cast("bigint")).drop(_CELL, _PLACE, _OFFSET)


def rank_desc(grouped: DataFrame, value: str, first_seen: str, out: str = "rank") -> DataFrame:
    """Rank rows by ``value`` descending, ties by ``first_seen`` ascending.

    The groups are written to the shared folder once and numbered from there,
    so the input behind them is read once however many groups there are.
    """
    return with_row_number(shared_table(grouped, "groups"), value, out, descending=True, tie_cols=(first_seen,))


def rank_text(df: DataFrame, name: str, out: str) -> DataFrame:
    """Place of each row in the order of a text column's code points, from 0 (a null counts as the empty text).

    The rows should be written already.
    """
    key = "__tf_text"
    ranked = with_row_number(df.withColumn(key, F.coalesce(F.col(name), F.lit(""))), key, out)
    return ranked.withColumn(out, F.col(out) - 1).drop(key)


def paginate(df: DataFrame, order_col: str, page_size: int,
             page_col: str = "page_no", slot_col: str = "slot",
             buckets: int | None = None) -> DataFrame:
    """Fixed-size pages in ``order_col`` order: 1-based page and slot numbers.

    The last page may be short; ``page_size <= 0`` or empty input gives no rows.
    """
    if page_size <= 0:
        return df.limit(0).withColumn(page_col, F.lit(None).cast("bigint")).withColumn(
            slot_col, F.lit(None).cast("bigint"))
    numbered = with_row_number(df, order_col, "__tf_rn", buckets)
    zero = F.col("__tf_rn") - 1
    return (
        numbered.withColumn(page_col, (F.floor(zero / page_size) + 1).cast("bigint"))
        .withColumn(slot_col, (F.pmod(zero, F.lit(page_size)) + 1).cast("bigint"))
        .drop("__tf_rn")
    )


def collect_pages(paged: DataFrame, page_col: str = "page_no", slot_col: str = "slot",
                  row_cols: list[str] | None = None) -> DataFrame:
    """One row per page with the page's rows as an ordered array.

    Each group holds at most ``page_size`` rows, so the grouping is bounded by
    the caller's page size, not by the data.
    """
    row_cols = row_cols or [c for c in paged.columns if c not in (page_col, slot_col)]
    rows = F.array_sort(F.collect_list(F.struct(F.col(slot_col), *[F.col(c) for c in row_cols])))
    return paged.groupBy(page_col).agg(rows.alias("rows"), F.count(F.lit(1)).alias("n_rows"))


def assign_ids(batch: DataFrame, order_col: str, first_id, out: str = "txn_id",
               buckets: int | None = None) -> DataFrame:
    """Sequential ids ``first_id, first_id + 1, ...`` in ``order_col`` order.

    ``first_id`` may be an int or a scalar Column (e.g. a scalar subquery of
    ``max(id) + 1``), so the base never travels through the driver.
    """
    base = first_id if not isinstance(first_id, int) else F.lit(first_id)
    numbered = with_row_number(batch.drop(out) if out in batch.columns else batch,
                               order_col, "__tf_rn", buckets)
    return numbered.withColumn(out, (base + F.col("__tf_rn") - 1).cast("bigint")).drop("__tf_rn")
