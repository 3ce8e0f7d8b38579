"""JSON array files read by many tasks.

An array file has no line structure to split at, so its elements are found by a
structural scan in two passes.  The text source cuts the file into splits that
begin behind a closing brace.  Pass one measures every split without knowing
where it stands: how many quotes it holds and how its brackets add up if it
began outside or inside a string.  Sums over the splits before give each split
its true start: in a string or not, depth, line.  Pass two cuts the splits at the
commas of depth one; what a border of splits tears apart is put together again
by the element's number.  Braces, brackets, commas and escaped quotes inside
strings are no structure.

A file that is no array is one value and is parsed by one task, to say what it is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.session import shared_table

_COMMA, _QUOTE, _BACKSLASH, _NEWLINE, _END = b',"\\\n]'
_STEP = np.zeros(256, "i1")
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r")] = True
_ONE_SCALAR = r'(?s)^[ \t\n\r]*("[^"\\]*(\\.[^"\\]*)*"|[^ \t\n\r"]+)[ \t\n\r]*$'


class ArraySyntaxError(ValueError):
    """The file is no JSON; ``line`` is where reading it would stop."""

    def __init__(self, line: int):
        self.line = line
        super().__init__(f"invalid JSON at line {line}")


class NotAnArray(ValueError):
    """The file holds one value of another kind."""

    def __init__(self, kind: str):
        self.kind = kind
        super().__init__(kind)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace (which the source leaves out), in file order inside a split."""
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), row.alias("row"), F.col("value").cast("binary").alias("value"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bytes]]:
    """Text of a split, a batch's rows at a time: the columns before ``value``, whether the split begins, and the text.

    A brace is given back in front of the row behind it, so that a split's last
    one is left to whoever knows whether the file ends in one.
    """
    before = None
    for batch in batches:
        if not len(batch):
            continue
        *keys, values = batch.columns
        changes = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False) for c in keys[:2]]
        for lo, hi in pairwise([0, *(np.flatnonzero(changes[0] | changes[1]) + 1).tolist(), len(batch)]):
            key = tuple(c[lo].as_py() for c in keys)
            rows = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), values.slice(lo, hi - lo))
            text = pc.binary_join(rows, b"}")[0].as_py()
            new = key[:2] != before
            before = key[:2]
            yield key, new, text if new else b"}" + text


class Structure(NamedTuple):
    raw: np.ndarray
    inside: np.ndarray  # an odd number of quotes stands before the byte
    odd: bool           # the text holds an odd number of quotes


def structure(text: bytes) -> Structure:
    """Quotes of a text that begins at a split or with a brace; one behind an odd run of backslashes is escaped."""
    raw = np.frombuffer(text, "u1")
    marks = raw == _QUOTE
    slashes = np.flatnonzero(raw == _BACKSLASH)
    if len(slashes):
        begins = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        ends = slashes[np.append(begins[1:] - 1, len(slashes) - 1)]
        escaped = (ends + 1)[(ends - slashes[begins]) % 2 == 0]
        marks[escaped[escaped < len(raw)]] = False
    upto = np.cumsum(marks, dtype="u1")  # only whether it is odd is asked
    return Structure(raw, ((upto ^ marks) & 1).astype(bool), bool(len(raw) and upto[-1] % 2))


_MEASURED = pa.schema([("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("odd", pa.int32()),
                       ("outside", pa.int64()), ("inside", pa.int64()), ("lines", pa.int64()), ("head", pa.string())])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass one: a split's bytes, whether its quotes are odd, how its brackets add up if it begins outside or inside a string, its lines and first sign."""
    now: dict | None = None

    def add(text: bytes) -> None:
        found = structure(text)
        step = _STEP[found.raw]
        at = np.flatnonzero(step)
        step, inside = step[at], found.inside[at]
        sums = int(step[~inside].sum(dtype="i8")), int(step[inside].sum(dtype="i8"))
        now["outside"] += sums[now["odd"]]
        now["inside"] += sums[1 - now["odd"]]
        now["odd"] ^= found.odd
        now["bytes"] += len(text)
        now["lines"] += int((found.raw == _NEWLINE).sum())
        now["head"] = now["head"] or text.lstrip(b" \t\n\r")[:1].decode("latin-1") or None

    for (file, block, size), new, text in _stretches(batches):
        if new:
            if now:
                add(b"}")
                yield pa.RecordBatch.from_pylist([now], _MEASURED)
            now = {"file": file, "block": block, "size": size, "bytes": 0, "odd": 0, "outside": 0, "inside": 0, "lines": 0, "head": None}
        add(text)
    if now:
        add(b"}")
        yield pa.RecordBatch.from_pylist([now], _MEASURED)


def _starts(measured: DataFrame) -> DataFrame:
    """Where every split stands: in a string, depth, line, whether the file has begun, and whether its last brace is one the file does not have."""
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c, default=0):
        return F.coalesce(F.sum(c).over(before), F.lit(default))

    known = measured.withColumn("in_string", so_far(F.col("odd")) % 2 == 1)
    step = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    known = known.withColumns({
        "depth": so_far(step), "line": so_far(F.col("lines")) + 1, "begun": so_far(F.when(F.col("head").isNotNull(), 1)) > 0, "step": step,
        "last": F.row_number().over(file.orderBy(F.desc("block"))) == 1, "total": F.sum("bytes").over(file)})
    known = known.withColumn("bare", F.col("last") & (F.col("total") > F.col("size")))
    ends_inside = F.col("in_string") != (F.col("odd") == 1)
    end = F.col("depth") + F.col("step") + F.when(F.col("bare") & ~ends_inside, 1).otherwise(0)
    return known.withColumn("open_at_end", F.when(F.col("last"), ends_inside | (end > 0))).select(
        "file", "block", "in_string", "depth", "line", "lines", "begun", "bare", "last", "open_at_end", "head")


_PIECE = "file string, block long, local long, whole boolean, line long, text string, nested long, plain long, problem long"
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("local", pa.int64()), ("whole", pa.bool_()), ("line", pa.int64()),
                     ("text", pa.string()), ("nested", pa.int64()), ("plain", pa.int64()), ("problem", pa.int64())])


class _Cutter:
    """Elements of one split, and the lines where something stands outside the array.

    ``nested`` counts an element's objects and arrays, ``plain`` its other signs
    (one of a string): parsers that stop behind the first value miss a second one.
    """

    def __init__(self, file: str, block: int, in_string: bool, depth: int, line: int, begun: bool):
        self.place = {"file": file, "block": block}
        self.in_string, self.depth, self.line, self.begun = in_string, depth, line, begun
        self.local, self.parts, self.since = 0, [], line if depth > 0 else None
        self.rows: list[dict] = []
        self.batches: list[pa.RecordBatch] = []
        self.nested = self.plain = 0
        self.closed = begun and depth <= 0

    def add(self, text: bytes) -> None:
        found = structure(text)
        raw, inside = found.raw, found.inside != self.in_string
        if not len(raw):
            return
        step, blank, comma = _STEP[raw], _BLANK[raw], (raw == _COMMA) & ~inside
        brackets = np.flatnonzero((step != 0) & ~inside)
        depths = self.depth + np.concatenate(([0], np.cumsum(step[brackets], dtype="i8")))  # before each bracket, and behind the last
        opens, closes = depths[:-1], depths[1:]
        level = np.clip(depths, 0, 2).astype("u1")  # outside the array, between its elements, in one that has brackets
        before = np.repeat(level, np.diff(np.concatenate(([0], brackets + 1, [len(raw)]))))
        after = before.copy()
        after[brackets] = level[1:]
        newlines = np.flatnonzero(raw == _NEWLINE)

        def behind(at):  # line behind a byte
            return self.line + np.searchsorted(newlines, at, side="right")

        out = np.flatnonzero((before == 0) & ~blank)
        if len(out) and not self.begun:  # the bracket that opens the array
            self.begun, out = True, out[1:]
        shut = brackets[(opens == 1) & (closes == 0)]
        wrong = np.concatenate((out, shut[raw[shut] != _END]))
        if len(wrong):
            at = int(wrong.min())
            self.rows.append(self.place | {"problem": int(behind(at) - (raw[at] == _NEWLINE))})
        content = (before > 0) & (after > 0)
        if self.closed:
            content[:] = False
        if len(shut):  # what opens behind the end is wrong already
            content[shut[0]:], self.closed = False, True
        if content.any():
            lo, hi = int(content.argmax()), len(raw) - int(content[::-1].argmax())
            commas = lo + np.flatnonzero((comma & (before == 1))[lo:hi])
            if self.since is None:
                self.since = int(behind(lo - 1)) if lo else self.line
            nested = brackets[(opens == 1) & (closes == 2)]
            plain = np.flatnonzero((before == 1) & (after == 1) & ~inside & ~blank & (raw != _COMMA))
            if len(commas):
                first, last = int(commas[0]), int(commas[-1])
                self._count(nested, plain, lo, first)
                self._end(text[lo:first])
                if last > first:
                    self._between(text, raw, commas, nested, plain, behind(commas[:-1]))
                lo, self.since = last + 1, int(behind(last))
            self._count(nested, plain, lo, hi)
            self.parts.append(text[lo:hi])
        elif self.since is None and (after >= 1).any():  # nothing yet behind the bracket
            self.since = int(behind(int((after >= 1).argmax())))
        self.depth, self.line, self.in_string = int(depths[-1]), int(behind(len(raw))), self.in_string != found.odd

    def _count(self, nested: np.ndarray, plain: np.ndarray, lo: int, hi: int) -> None:
        self.nested += int(np.diff(np.searchsorted(nested, (lo, hi)))[0])
        self.plain += int(np.diff(np.searchsorted(plain, (lo, hi)))[0])

    def _between(self, text: bytes, raw: np.ndarray, commas: np.ndarray, nested: np.ndarray, plain: np.ndarray, lines: np.ndarray) -> None:
        """The elements from the first comma to the last, all of them whole, as one batch."""
        n, first, last = len(commas) - 1, int(commas[0]), int(commas[-1])
        try:
            text[first:last].decode("utf-8")
            kept = np.ones(last - first - 1, bool)
            kept[commas[1:-1] - first - 1] = False
            offsets = (commas - first - np.arange(n + 1)).astype("i4")
            texts = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[first + 1:last][kept]))
        except UnicodeDecodeError:
            texts = pa.array([text[lo + 1:hi].decode("utf-8", "replace") for lo, hi in pairwise(commas.tolist())], pa.string())
        counts = [np.diff(np.searchsorted(at, commas)).astype("i8") for at in (nested, plain)]
        self.batches.append(pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(self.place["file"], pa.string()), n), pa.repeat(pa.scalar(self.place["block"], pa.int64()), n),
            pa.array(np.arange(self.local, self.local + n, dtype="i8")), pa.repeat(pa.scalar(True), n), pa.array(lines.astype("i8")), texts,
            *map(pa.array, counts), pa.nulls(n, pa.int64())], schema=_PIECES))
        self.local += n

    def _end(self, text: bytes, whole: bool = True) -> None:
        self.parts.append(text)
        self.rows.append(self.place | {"local": self.local, "whole": whole and self.local > 0, "line": self.since, "text": b"".join(self.parts).decode("utf-8", "replace"),
                                       "nested": self.nested, "plain": self.plain})
        self.local, self.parts, self.nested, self.plain = self.local + 1, [], 0, 0

    def taken(self, end: bool = False) -> list[pa.RecordBatch]:
        if end and self.since is not None:
            self._end(b"", whole=False)
        found, self.rows, self.batches = [pa.RecordBatch.from_pylist(self.rows, _PIECES), *self.batches], [], []
        return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass two: the elements of each split; its first and last may go on in its neighbours."""
    cutter, bare = None, False

    def finished() -> list[pa.RecordBatch]:
        if not bare:
            cutter.add(b"}")
        return cutter.taken(end=True)

    for (file, block, in_string, depth, line, begun, ends_bare), new, text in _stretches(batches):
        if new:
            if cutter:
                yield from finished()
            cutter, bare = _Cutter(file, block, in_string, depth, line, begun), ends_bare
        cutter.add(text)
        yield from cutter.taken()
    if cutter:
        yield from finished()


def _whole_value(spark: SparkSession, file: str) -> Exception:
    """What a file that does not begin as an array is: one value, read as such."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                try:
                    said = type(json.loads(text or "")).__name__, None
                except json.JSONDecodeError as e:
                    said = None, e.lineno
                yield pa.RecordBatch.from_pylist([dict(zip(("kind", "line"), said))], pa.schema([("kind", pa.string()), ("line", pa.int64())]))

    said = spark.read.text(file, wholetext=True).mapInArrow(look, "kind string, line long").first()
    return ArraySyntaxError(1) if said is None else NotAnArray(said["kind"]) if said["kind"] else ArraySyntaxError(said["line"])


def _error_line(text: str, line: int) -> int:
    """Line at which reading stops in an element that is no JSON and begins in ``line``."""
    if not text.strip(" \t\n\r"):
        return line + text.count("\n")
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        return line + e.lineno - 1
    return line


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """Elements of the array files at ``path``: ``pos`` (from 0 in its file), ``v`` variant.

    Raises ``NotAnArray`` or, naming the line where reading would stop,
    ``ArraySyntaxError``: a file is an array as a whole or not at all.  The
    elements are written to the shared folder once, as they are cut, and read from there.
    """
    chunks = _chunks(spark, path)
    measured = chunks.select("file", "block", "size", "value").mapInArrow(
        _measure, "file string, block long, size long, bytes long, odd int, outside long, inside long, lines long, head string")
    starts = shared_table(_starts(measured), "array-starts")
    if starts.isEmpty() and spark.read.text(path).inputFiles():  # a scan leaves empty files out, the listing does not
        raise ArraySyntaxError(1)  # nothing in the file
    first_sign = F.min_by("head", F.when(F.col("head").isNotNull(), F.col("block")))
    strange = starts.groupBy("file").agg(first_sign.alias("head")).where("head is null or head <> '['").agg(F.min("file")).first()[0]
    if strange is not None:
        raise _whole_value(spark, strange)

    # in file order whatever join the planner takes; sorted rows stay where they are
    placed = chunks.join(starts.select("file", "block", "in_string", "depth", "line", "begun", "bare"), ["file", "block"])
    ordered = placed.sortWithinPartitions("file", "block", "row").select("file", "block", "in_string", "depth", "line", "begun", "bare", "value")
    one = F.when(F.col("nested") == 0, F.col("text").rlike(_ONE_SCALAR)).otherwise((F.col("nested") == 1) & (F.col("plain") == 0))
    good = one & F.try_parse_json("text").isNotNull()
    pieces = shared_table(ordered.mapInArrow(_cut, _PIECE).withColumn("good", F.when(F.col("whole"), good)), "array-pieces")
    # a split ends in a piece that is not whole; written, so that the planner knows the size and whole pieces stay where they are
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.where("not whole").groupBy("file", "block").agg(F.max("local").alias("commas"))
    counts = shared_table(counts.withColumn("before", F.coalesce(F.sum("commas").over(before), F.lit(0))), "array-counts")
    numbered = pieces.where("local is not null").join(counts, ["file", "block"]).withColumn("pos", F.col("before") + F.col("local"))
    torn = numbered.where("not whole").groupBy("file", "pos").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts"), F.sum("nested").alias("nested"), F.sum("plain").alias("plain")).select(
        "file", "pos", F.get("parts", F.lit(0))["line"].alias("line"), F.array_join(F.col("parts.text"), "").alias("text"), "nested", "plain")
    columns = ["file", "pos", "line", "text", "good"]
    # the text is stored, not the variant: a written column of variants does not keep 20 and 20.0 apart
    every = numbered.where("whole").select(columns).unionByName(shared_table(torn.withColumn("good", good).select(columns), "array-torn"))

    empty = F.col("text").rlike(r"^[ \t\n\r]*$")
    sizes = counts.groupBy("file").agg(F.max(F.col("before") + F.col("commas")).alias("end"))
    bad = every.where(~F.col("good")).join(sizes, "file", "left")
    kept = bad.where(~(empty & (F.col("end") == 0)))  # the nothing in an empty array
    first = kept.agg(F.min_by(F.struct("text", "line", (empty & (F.col("pos") == F.col("end"))).alias("trailing"), "file"), F.struct("file", "pos"))).first()[0]
    ends = starts.where("open_at_end").agg(F.min(F.struct("file", (F.col("line") + F.col("lines")).alias("line")))).first()[0]
    outside = pieces.where("problem is not null").agg(F.min(F.struct("file", F.col("problem").alias("line")))).first()[0]
    found = []
    if first is not None:
        broken_off = ends is not None and ends["file"] == first["file"] and first["trailing"]
        found.append((first["file"], ends["line"] if broken_off else first["line"] if first["trailing"] else _error_line(first["text"], first["line"])))
    found += [(r["file"], r["line"]) for r in (ends, outside) if r is not None]
    if found:
        raise ArraySyntaxError(min(found)[1])
    return every.where("good").select("pos", F.try_parse_json("text").alias("v"))
