"""Filter interaction audit by truth-table survival words.

Every document becomes one 32-bit word: bit ``S`` tells whether it survives the
subset ``S`` of the five filters, that is, fails none of them.  The word is the
product of the truth tables of the filters it fails, so how often each bit is
set, summed over a part's documents, is the number of survivors of every subset.
Each order, step and Shapley value of the audit is a difference of those 32
numbers.  The bits are counted by carry-save adders: three words become a sum
and a carry word, and only the last few are looked at bit by bit.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import byte_slices, give_back, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
CLASSES = ("all", "good", "toxic")
_CAPITAL, _SIGN = np.zeros((2, 256), bool)
_CAPITAL[ord("A"):ord("Z") + 1] = True
_SIGN[list(b"#$%&*|")] = True
#: Text that a task looks at together.
SLICE_BYTES = 8 << 20
#: A task adds up its counts when this many words wait, and hands them on when it holds this many parts.
FLUSH_WORDS, FLUSH_PARTS = 1 << 20, 1 << 12


def _truth_tables() -> np.ndarray:
    """``[f]``: bit ``S`` is set when none of the filters in ``f`` is in ``S``."""
    subsets = np.arange(SUBSETS)
    return np.array([np.bitwise_or.reduce((1 << subsets)[subsets & f == 0]) for f in range(SUBSETS)], "u4")


TRUTH = _truth_tables()


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set."""
    counts, level, weight = np.zeros(32, "i8"), words, 1
    while len(level):
        carries = []
        while len(level) > 2:  # sum and carry of every three words
            third = len(level) // 3
            a, b, c = level[:third], level[third:2 * third], level[2 * third:3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            level = np.concatenate((half ^ c, level[3 * third:]))
        for word in level:
            counts += weight * ((int(word) >> np.arange(32)) & 1)
        level, weight = (np.concatenate(carries) if carries else level[:0]), 2 * weight
    return counts


def weighted_counts(words: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """The same with each word standing for so many documents, one binary digit of the copies at a time."""
    counts, digit = np.zeros(32, "i8"), 0
    while (left := copies >> digit).any():
        counts += positional_counts(words[left & 1 == 1]) << digit
        digit += 1
    return counts


def failures(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3 for each (non-null) text: which of the filters A to D it fails."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    row = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    flat = words.flatten()
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # a text without words splits to one empty string
    coded = flat.dictionary_encode()
    row, which = row[some], coded.indices.to_numpy()[some]
    n = np.bincount(row, minlength=len(texts))
    seen = np.sort(row * len(coded.dictionary) + which)
    distinct = np.bincount(seen[np.diff(seen, prepend=-1) != 0] // max(1, len(coded.dictionary)), minlength=len(texts))
    raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), "u1")
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy())))

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[raw], dtype="i4")))[ends])

    chars = pc.utf8_length(texts).to_numpy().astype("i8")
    fails = [n < 50, 100 * distinct < 65 * n, 100 * count(_CAPITAL).astype("i8") > 5 * chars, count(_SIGN) > 0]
    return sum(f.astype("i4") << i for i, f in enumerate(fails))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in byte_slices(batch.column(2), SLICE_BYTES):
            some = batch.slice(lo, hi - lo)
            texts = some.column(2)
            digests = [hashlib.sha256(t).digest() for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(digests, pa.binary()), pa.array(failures(texts), pa.int32())],
                                             names=["__id", "__part", "__digest", "__fails"])
    give_back()


def _labels(labels: DataFrame, id_col: str) -> DataFrame:
    def any_one(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col(name) == 1, 1)), F.lit(0)).alias(f"__{name}")
    return labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__label_id")).agg(any_one("quality"), any_one("toxic"))


def _outcomes(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``part, quality, toxic, fails, copies``: documents by the filters they fail.

    Equal rows are added up before any shuffle, so a text that fills a third of
    the table is a few rows a task.  The first of equal texts is found from the
    smallest ids of their groups.
    """
    narrow = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("__part"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    id_type = narrow.schema["__id"].dataType.simpleString()
    rows = narrow.mapInArrow(_judged, f"__id {id_type}, __part string, __digest binary, __fails int")
    each = rows.groupBy("__id", "__digest", "__part", "__fails").agg(F.count(F.lit(1)).alias("__n"))
    known = each.join(_labels(labels, id_col), F.col("__id") == F.col("__label_id"), "left").fillna(0, ["__quality", "__toxic"])
    first = F.min(F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__n").alias("n"))).alias("__first")
    groups = stored(known.groupBy("__digest", "__part", "__quality", "__toxic", "__fails").agg(F.sum("__n").alias("__n"), first), "audit-texts")
    place = F.struct("__first.no_id", "__first.id")
    origin = groups.groupBy(F.col("__digest").alias("__same")).agg(F.min(place).alias("__origin"))
    judged = groups.join(origin, F.col("__digest") == F.col("__same"))
    originals = F.when(place == F.col("__origin"), F.col("__first.n")).otherwise(F.lit(0))
    both = F.array(F.struct(F.col("__fails").alias("fails"), originals.alias("copies")),
                   F.struct((F.col("__fails") + (1 << FILTERS.index("E"))).alias("fails"), (F.col("__n") - originals).alias("copies")))
    return judged.select(F.col("__part").alias("part"), F.col("__quality").alias("quality"), F.col("__toxic").alias("toxic"),
                         F.inline(both)).where("copies > 0")


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's survivors of every subset by part: of all documents, of the good and of the toxic ones."""
    waiting: list[tuple] = []
    held: dict[str, np.ndarray] = defaultdict(lambda: np.zeros((len(CLASSES), SUBSETS), "i8"))

    def add_up() -> None:
        parts = pa.concat_arrays([w[0] for w in waiting]).dictionary_encode()
        quality, toxic, fails, copies = (np.concatenate(c) for c in list(zip(*waiting))[1:])
        waiting.clear()
        key = parts.indices.to_numpy().astype("i8") * 4 + quality * 2 + toxic
        order = np.argsort(key, kind="stable")
        key, words, copies = key[order], TRUTH[fails[order]], copies[order]
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        names = parts.dictionary.to_pylist()
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            label = int(key[lo]) & 3
            held[names[int(key[lo]) >> 2]][[True, label & 2 > 0, label & 1 > 0]] += weighted_counts(words[lo:hi], copies[lo:hi])

    def hand_on() -> pa.RecordBatch:
        names, counts = list(held), [c.ravel().tolist() for c in held.values()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.list_(pa.int64()))], names=["part", "survivors"])

    size = 0
    for batch in batches:
        waiting.append((batch.column(0), *(batch.column(i).to_numpy() for i in range(1, 5))))
        size += batch.num_rows
        if size >= FLUSH_WORDS:
            add_up()
            size = 0
            if len(held) >= FLUSH_PARTS:
                yield hand_on()
    if size:
        add_up()
    yield hand_on()


def survivors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, survivors``: for each of ``CLASSES`` in turn, the documents that survive subset 0, 1, ... of the filters."""
    counted = _outcomes(docs, labels, id_col, text_col, part_col).mapInArrow(_survivors, "part string, survivors array<long>")
    return counted.groupBy("part").agg(F.array(*[F.sum(F.get("survivors", F.lit(i))) for i in range(len(CLASSES) * SUBSETS)]).alias("survivors"))


def _plan() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Every order with every step: the order, the step, the filters before it as a subset, and its filter."""
    steps = [("".join(order), k + 1, sum(1 << FILTERS.index(f) for f in order[:k]), FILTERS.index(order[k]))
             for order in permutations(FILTERS) for k in range(len(FILTERS))]
    names, *numbers = zip(*steps)
    return list(names), *(np.array(n) for n in numbers)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, step, before, which = _plan()
    one = 1 << which
    after, everything = before | one, SUBSETS - 1
    subsets = np.arange(SUBSETS)
    size = np.array([s.bit_count() for s in range(SUBSETS)])
    # how many orders have exactly these filters before the one in question
    weight = np.array([factorial(k) * factorial(max(0, len(FILTERS) - 1 - k)) for k in size])
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            alive, good, toxic = np.array(counts, "i8").reshape(len(CLASSES), SUBSETS)
            removed = alive[before] - alive[after]
            shapley = np.array([(weight * (alive - alive[subsets | 1 << x]))[subsets >> x & 1 == 0].sum() for x in range(len(FILTERS))])
            numbers = [alive[after], removed, alive[0] - alive[one] - removed, alive[everything - one] - alive[everything],
                       good[before] - good[after], toxic[before] - toxic[after], shapley[which]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(orders), pa.string()), pa.array(orders), pa.array(step, pa.int32()), *(pa.array(n, pa.int64()) for n in numbers)],
                names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step.

    ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.  A null part or text is the empty string.
    Repeated rows are so many documents.  A null id is larger than any other and
    has no labels; rows of one id are no copies of each other.  A document is
    good or toxic if any row of its labels says 1.  Without documents there are
    no rows.  Other columns are not read.
    """
    return survivors(docs, labels, id_col, text_col, part_col).mapInArrow(
        _audited, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                  "unique_fails long, good_lost long, toxic_lost long, shapley long")
