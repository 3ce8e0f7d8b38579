"""Log analytics: parse, filter, count per level, pages, first page, scan depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.numbering import paginate, rank_desc


E_LINE = "malformed"


def parse_lines(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Split ``DATE TIME LEVEL message`` into ``ts``, ``level``, ``msg``.

    At most four fields; the message keeps its spaces and empty fields count
    (a double space gives an empty level).  Lines with fewer than four fields
    get ``malformed = true`` and null fields instead of stopping the job.
    """
    parts = F.split(F.col(line_col), " ", 4)
    ok = F.size(parts) == 4
    return df.withColumns({
        "ts": F.when(ok, F.concat_ws(" ", F.get(parts, 0), F.get(parts, 1))),
        "level": F.when(ok, F.get(parts, 2)),
        "msg": F.when(ok, F.get(parts, 3)),
        "malformed": ~ok,
    })


def only(df: DataFrame, level: str) -> DataFrame:
    """Records whose level equals ``level`` exactly (case-sensitive)."""
    return df.where(F.col("level") == F.lit(level))


def line_metrics(parsed: DataFrame) -> DataFrame:
    """Lines read, malformed lines and distinct levels, from one aggregate."""
    return parsed.agg(F.count(F.lit(1)).alias("lines_read"), F.count_if("malformed").alias("malformed"),
                      F.countDistinct(F.when(~F.col("malformed"), F.col("level"))).alias("levels"))


def line_errors(parsed: DataFrame, pos_col: str = "pos") -> DataFrame:
    """``error_code`` and ``error`` of malformed lines, for the policies of ``operators.rules``."""
    bad = F.col("malformed")
    return parsed.withColumns({
        "error_code": F.when(bad, F.lit(E_LINE)),
        "error": F.when(bad, F.concat(F.lit("line at position "), F.col(pos_col).cast("string"), F.lit(" has fewer than four fields")))})


def level_counts(parsed: DataFrame, pos_col: str = "pos") -> DataFrame:
    """Count per level, most common first; ties keep first-seen order.

    A partial + final hash aggregate; the groups are ranked by range numbering,
    since a level is free text and there may be very many.
    """
    grouped = parsed.where(~F.col("malformed")).groupBy("level").agg(
        F.count(F.lit(1)).alias("n"), F.min(pos_col).alias("first_pos"))
    return rank_desc(grouped, "n", "first_pos")


def first_page(parsed: DataFrame, level: str, page_size: int, pos_col: str = "pos") -> DataFrame:
    """The first ``page_size`` records of ``level`` in input order
    (``TakeOrderedAndProject``: a bounded top-n per task, no full sort)."""
    if page_size <= 0:
        return parsed.limit(0)
    return only(parsed, level).orderBy(pos_col).limit(page_size)


def pages(parsed: DataFrame, level: str, page_size: int, pos_col: str = "pos",
          buckets: int | None = None) -> DataFrame:
    """Every record of ``level`` with its 1-based ``page_no`` and ``slot``."""
    return paginate(only(parsed, level), pos_col, page_size, buckets=buckets)


def scan_depth(parsed: DataFrame, level: str, page_size: int, pos_col: str = "pos") -> DataFrame:
    """How many lines a lazy reader consumes before the first page is full.

    That is the number of lines up to and including the ``page_size``-th
    match, or every line when there are fewer matches.  The page itself (at most
    ``page_size`` positions) is taken first; the count then stops at its last
    position, a filter that reaches the scan.
    """
    page = [r[0] for r in first_page(parsed, level, page_size, pos_col).select(pos_col).collect()]
    if page_size <= 0:
        parsed = parsed.limit(0)
    elif len(page) == page_size:
        parsed = parsed.where(F.col(pos_col) <= F.lit(max(page)))
    return parsed.agg(F.count(F.lit(1)).alias("lines_read")).withColumn("matches_in_page", F.lit(len(page)).cast("bigint"))
