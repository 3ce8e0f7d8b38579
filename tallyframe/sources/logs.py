"""Log line sources and sinks.

``read_log_text`` gives every line a numeric position that follows file order
(file, split, line inside the split) so that paging, scan depth and "first
seen" tie-breaks work on many files and many splits.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.numbering import rank_text
from tallyframe.session import shared_table

# The synthetic log's level slots (INFO weighted 3 of 6) and its
# six messages, in the order the generator draws from.
LEVELS = ["INFO", "INFO", "INFO", "DEBUG", "WARNING", "ERROR"]
MESSAGES = [
    "user logged in", "payment processed", "cache miss",
    "db connection slow", "invalid token", "timeout contacting service",
]
LOG_DATE = "2026-06-11"
LOG_HOUR = "10"

_SPLIT_SCALE = 10 ** 9   # rows per split stay far below this
_FILE_SCALE = 10 ** 24   # byte offsets inside one file stay far below 10**15


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` with its file, split and place in the split."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("__row"))


def _position(index: Column) -> Column:
    def scale(n: int):
        return F.lit(str(n)).cast("decimal(38,0)")
    return (index.cast("decimal(38,0)") * scale(_FILE_SCALE) + F.col("__block").cast("decimal(38,0)") * scale(_SPLIT_SCALE)
            + F.col("__row")).cast("decimal(38,0)")


def file_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``__file``, ``__name``: every input file, as its metadata and in plain letters.  Only the listing is read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("__file"))
    return files.withColumn("__name", F.url_decode(F.replace("__file", F.lit("+"), F.lit("%2B"))))


def read_log_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line: ``pos decimal(38,0)``, ``value string``.

    ``pos`` orders lines as a reader going file by file (sorted paths), top to
    bottom would meet them.  A split never straddles partitions, so within one
    (file, split) the partition-local row index is the line order.  The files
    are ranked as a table, whatever their number.
    """
    lines, files = _lines(spark, path), file_table(spark, path)
    if len(files.limit(2).collect()) <= 1:
        return lines.select(_position(F.lit(0)).alias("pos"), "value")
    # written, so that the planner knows its size and broadcasts it while that is small
    ranks = shared_table(rank_text(shared_table(files, "files"), "__name", "__index").select("__file", "__index"), "file-ranks")
    return lines.join(ranks, "__file").select(_position(F.col("__index")).alias("pos"), "value")


@dataclasses.dataclass
class Page:
    """The first records of a level, and how far the files were read for them."""

    rows: DataFrame
    lines_read: int
    matches: int


def first_page_of(spark: SparkSession, path: str | list[str], level: str, page_size: int) -> Page:
    """The first ``page_size`` records of ``level`` in the files at ``path``, reading no further than the page needs.

    Files are taken in order of their paths, one at first and twice as many each
    time.  Within the first file Spark goes through the splits in order and
    leaves a split as soon as the page is full.  Rows: ``pos, ts, level, msg``;
    ``lines_read`` counts the lines up to the last record of a full page, or all.
    """
    from tallyframe.operators.logs import only, parse_lines

    names, found, last, index, batch = file_table(spark, path), [], None, 0, 1
    schema = "pos decimal(38,0), ts string, level string, msg string"
    before: list[str] = []
    while len(found) < page_size:
        here = [r[0] for r in (names if last is None else names.where(F.col("__name") > last)).orderBy("__name").limit(batch).select("__name").collect()]
        if not here:
            break
        index_of = {n: index + i for i, n in enumerate(here)}
        lines = _lines(spark, [_literal(n) for n in here])
        if len(here) > 1:
            number = F.element_at(F.create_map(*[F.lit(v) for kv in index_of.items() for v in kv]), F.url_decode(F.replace("__file", F.lit("+"), F.lit("%2B"))))
            lines = lines.withColumn("__index", number)
        else:
            lines = lines.withColumn("__index", F.lit(index))
        matched = only(parse_lines(lines), level).select("__index", "__block", "__row", _position(F.col("__index")).alias("pos"), "ts", "level", "msg")
        found += (matched.orderBy("pos") if len(here) > 1 else matched).limit(page_size - len(found)).collect()
        before += here
        last, index, batch = here[-1], index + len(here), batch * 2
    rows = spark.createDataFrame([(r["pos"], r["ts"], r["level"], r["msg"]) for r in found], schema)
    if page_size <= 0:
        return Page(rows, 0, 0)
    if len(found) < page_size:
        return Page(rows, spark.read.text(path).count() if before else 0, len(found))
    end = found[-1]
    if end["__index"] == 0 and end["__block"] == 0:
        return Page(rows, end["__row"] + 1, len(found))
    earlier = before[:end["__index"]]
    whole = spark.read.text([_literal(n) for n in earlier]).count() if earlier else 0
    same = _lines(spark, _literal(before[end["__index"]])).where(
        (F.col("__block") < end["__block"]) | ((F.col("__block") == end["__block"]) & (F.col("__row") <= end["__row"]))).count()
    return Page(rows, whole + same, len(found))


def _literal(path: str) -> str:
    """A file name as a path of its own: characters that a listing takes for patterns are escaped."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def _draw(i: Column, seed: int, n: int) -> Column:
    """A number below ``n`` from the first digits of an MD5, the same in any engine."""
    digits = F.substring(F.md5(F.concat(i.cast("string"), F.lit(f":{seed}"))), 1, 7)
    return F.pmod(F.conv(digits, 16, 10).cast("int"), F.lit(n))


def fake_log_lines(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Synthetic log lines, one per id: ``YYYY-MM-DD 10:MM:SS LEVEL message``.

    Minute and second are ``id % 60``; level and message are drawn from the
    fixed lists by a seeded hash of the id, so the rows do not depend on how
    the ids are partitioned (``rand(seed)`` would).
    """
    i = F.col(id_col)
    mmss = F.lpad(F.pmod(i, F.lit(60)).cast("string"), 2, "0")
    levels = F.array(*[F.lit(x) for x in LEVELS])
    messages = F.array(*[F.lit(x) for x in MESSAGES])
    level = F.element_at(levels, _draw(i, seed, len(LEVELS)) + 1)
    message = F.element_at(messages, _draw(i, seed + 1, len(MESSAGES)) + 1)
    line = F.concat_ws(" ", F.lit(LOG_DATE), F.concat_ws(":", F.lit(LOG_HOUR), mmss, mmss), level, message)
    return ids.select(i.alias("pos"), line.alias("value"))


def generate_log_lines(spark: SparkSession, n: int, seed: int = 42,
                       partitions: int | None = None) -> DataFrame:
    """``n`` synthetic lines from ``spark.range`` (distributed, no driver data)."""
    return fake_log_lines(spark.range(0, n, 1, partitions), "id", seed)


def write_lines(df: DataFrame, path: str, col: str | Column = "value") -> None:
    """Text sink: one line per row, replacing whatever was at ``path``."""
    c = F.col(col) if isinstance(col, str) else col
    df.select(c.alias("value")).write.mode("overwrite").text(path)
