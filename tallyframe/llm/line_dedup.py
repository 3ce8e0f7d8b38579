"""Removal of repeated runs of lines, by winnowing over line hashes.

A run is a stretch of consecutive lines of one document with at least
``min_words`` words.  It is repeated when an equal run stands earlier: in a
document of smaller id, or further up in the same one.

* Every line opens the shortest run that starts with it and closes the shortest
  that ends with it.  Of each such window the line of least hash is selected: a
  fingerprint that any equal window anywhere must select too.
* Fingerprints are joined over all documents.  Only those found at two places
  or more go on; nearly all windows end here.
* A match is extended both ways from its fingerprint: window by window, those
  that open further up and those that close further down are compared by the
  hash of their whole sequence of lines, and the first place of each sequence is
  kept.  Every line of a repeated run lies in a repeated window that opens or
  closes inside the run, so the windows together are the run.
* Lines covered by a window that stands earlier are deleted.

Only DataFrame functions; groups are keyed by document or summed by key with
partial sums, so a line that stands everywhere costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import stored

MIN_WORDS = 50
#: Spaces around a line do not count.
EDGE_SPACES = " \t\r"


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """``place, first, last, fingerprint, at, run``: every shortest run of every document."""
    split = docs.select("place", F.split("body", "\n").alias("lines"))
    lines = split.select("place", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "raw")).select(
        "place", "n", "pos", F.btrim("raw", F.lit(EDGE_SPACES)).alias("line")).where("line <> ''").select(
        "place", "n", "pos", F.xxhash64("line").alias("hash"),
        (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1).alias("words"))
    lines = lines.repartition("place").groupBy("place", "pos").agg(*(F.first(c).alias(c) for c in ("n", "hash", "words")))
    by_doc = Window.partitionBy("place")
    counted = lines.withColumn("end", F.coalesce(F.lead("pos").over(by_doc.orderBy("pos")), "n") - 1).withColumn("upto", F.sum("words").over(by_doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    counted = counted.withColumn("before", F.col("upto") - F.col("words")).withColumn("total", F.max("upto").over(by_doc))
    counted = counted.where(F.col("total") >= min_words)

    def run(frame) -> Column:
        least, sequence = F.min(F.struct("hash", "pos")).over(frame), F.collect_list("hash").over(frame)
        return F.struct(F.min("pos").over(frame).alias("first"), F.max("end").over(frame).alias("last"),
                        least["hash"].alias("fingerprint"), least["pos"].alias("at"), F.xxhash64(sequence, F.size(sequence)).alias("run"))

    opened = F.when(F.col("before") + min_words <= F.col("total"), run(by_doc.orderBy("before").rangeBetween(0, min_words - 1)))
    closed = F.when(F.col("upto") >= min_words, run(by_doc.orderBy("upto").rangeBetween(1 - min_words, 0)))
    both = counted.select("place", F.array_distinct(F.array(opened, closed)).alias("both"))
    return both.select("place", F.explode("both").alias("w")).where("w is not null").select("place", "w.*")


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``place, first, last`` of windows whose lines stand earlier too; ``docs`` has ``place, body``."""
    windows = stored(_windows(docs, min_words), "windows")
    at = F.struct("place", "at")
    shared = windows.groupBy("fingerprint").agg(F.min(at).alias("low"), F.max(at).alias("high")).where("low <> high")
    joined = stored(windows.join(shared.select("fingerprint"), "fingerprint", "left_semi"), "joined")
    start = F.struct("place", "first")
    origin = joined.groupBy("run").agg(F.min(start).alias("origin"), F.max(start).alias("other")).where("origin <> other").select("run", "origin")
    return joined.join(origin, "run").where(start > F.col("origin")).select("place", "first", "last")


def merged_spans(windows: DataFrame) -> DataFrame:
    """``place, first, last``: windows that overlap or touch as one."""
    in_order = Window.partitionBy("place").orderBy("first", "last")
    earlier = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = windows.withColumn("apart", F.when(F.col("first") <= earlier + 1, 0).otherwise(1))
    numbered = apart.withColumn("span", F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("place", "span").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("span")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with later repeated runs taken out of ``text_col``, and ``lines_removed int``.

    All columns stay.  The first place of a run keeps it: documents stand in
    the order of ``id_col`` (null last), then of the text's hash.  Rows that
    agree in id and text are one document and are treated alike.  A null text
    stays null, an empty one empty; a text all of whose lines are repeated
    becomes empty.  Lines are compared without spaces at their ends, their
    words are counted by single spaces; a blank line is never compared and goes
    with the line before it.
    """
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    narrow = docs.select(place.alias("place"), F.col(text_col).alias("body")).where("body is not null")
    spans = merged_spans(repeated_windows(narrow, min_words)).groupBy("place").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    gone = spans.select("place.id", "place.text_hash", "spans")

    text = F.col(f"d.`{text_col}`")
    both = docs.alias("d").join(gone.hint("shuffle_hash").alias("g"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.id")) & (F.xxhash64(text) == F.col("g.text_hash")), "left")
    spans = F.col("g.spans")

    def between(lines: Column) -> Column:
        """The lines before each span, and behind the last."""
        def before(span: Column, i: Column) -> Column:
            start = F.coalesce(F.get(spans, i - 1)["last"] + 2, F.lit(1))
            return F.slice(lines, start, span["first"] + 1 - start)

        tail = F.slice(lines, F.get(spans, F.size(spans) - 1)["last"] + 2, F.size(lines))
        return F.array_join(F.concat(F.flatten(F.transform(spans, before)), tail), "\n")

    # a variable holds the lines, so that a text is split once and not for every span
    changed = F.when(spans.isNull(), text).otherwise(F.get(F.transform(F.array(F.split(text, "\n")), between), F.lit(0)))
    removed = F.when(spans.isNull(), 0).otherwise(F.aggregate(spans, F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)).alias("lines_removed")
    return both.select(*(changed.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns if c != "lines_removed"), removed)
