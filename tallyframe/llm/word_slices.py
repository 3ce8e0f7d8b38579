"""Texts as slices of numbered words, and counts that go out from slices and come back.

A slice is a bounded run of documents of one input partition.  Its words are
numbered in the slice and each distinct word is written once beside the
numbers, so only distinct words (later: distinct keys) are shuffled, not their
occurrences.  Keys of a slice travel in blocks: sorted, cut into buckets by a
hash, differences and compression instead of rows.  A bucket adds up the blocks
of all slices; a key has one entry a slice at most, so no key fills a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import byte_slices, give_back, stored
from tallyframe.llm.shingles import mixed

#: Text in a slice (a longer document is alone), and text that is split at once.
SLICE_BYTES, CHUNK_BYTES = 32 << 20, 4 << 20
#: Words of input for each bucket of keys.
BUCKET_WORDS = 4_000_000

WORD, BLANK, BREAK = 0, 1, 2
_LOWER = np.arange(256, dtype="u1")
_LOWER[ord("A"):ord("Z") + 1] += 32


def kinds(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: part of a word, a blank between words, or a break that ends a piece."""
    table = np.zeros(256, "u1")
    table[list(blanks)] = BLANK
    table[list(breaks)] = BREAK
    return table


_SMALLER = pa.Codec("zstd", compression_level=4)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed bytes, low bytes first, then the next ones, and so on."""
    planes = np.ascontiguousarray(numbers).view("u1").reshape(-1, numbers.dtype.itemsize).T
    return np.array([len(numbers)], "<i8").tobytes() + _SMALLER.compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    n, size = int(np.frombuffer(data, "<i8", 1)[0]), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd", asbytes=True), "u1").reshape(size, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def packed_sorted(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=keys.dtype.type(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "u8"), dtype="u8")


def packed_words(words: list[bytes]) -> bytes:
    """Words (that hold no ASCII white space) as compressed bytes."""
    return packed(np.frombuffer(b"\n".join(words), "u1"))


def unpacked_words(data: bytes) -> bytes:
    return unpacked(data, "u1").tobytes()


def split_words(texts: list[bytes], kind: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of the texts with A-Z lower-cased: the words, the first word of each text (and the end), whether a break stands before a word."""
    raw = np.frombuffer(b"\n".join(texts), "u1")
    what = kind[raw]
    ends = np.cumsum([len(t) + 1 for t in texts])
    what[ends[:-1] - 1] = BREAK
    solid = what == WORD
    edges = np.flatnonzero(np.diff(np.concatenate(([0], solid.view("i1"), [0]))))
    start, stop = edges[::2], edges[1::2]
    offsets = np.zeros(len(start) + 1, "i4")
    np.cumsum(stop - start, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[solid]])])
    breaks = np.cumsum(what == BREAK, dtype="i4")
    at = breaks[start]
    first = np.searchsorted(start, np.concatenate(([0], ends)))
    return words.dictionary_encode(), first, np.diff(at, prepend=0) > 0


class Numbers:
    """Words of a slice by group: number (from 1) and, for each class, how often they occurred."""

    def __init__(self, classes: int = 1):
        self.known: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = []
        self.groups: list[tuple[str, int, int]] = []  # group, first and last number: runs in order of appearance
        self.counts = [np.zeros(1, "i8") for _ in range(classes)]

    def of(self, group: str, words: pa.DictionaryArray) -> np.ndarray:
        table, before = self.known.setdefault(group, {}), len(self.words)
        numbers = []
        for word in words.dictionary.to_pylist():
            n = table.get(word)
            if n is None:
                self.words.append(word)
                n = table[word] = len(self.words)
            numbers.append(n)
        if len(self.words) > before:
            self.groups.append((group, before + 1, len(self.words)))
        return np.array(numbers, "u4")[words.indices.to_numpy()] if numbers else np.empty(0, "u4")

    def counted(self) -> list[np.ndarray]:
        """Counts of the numbers 1, 2, ... by class."""
        return [np.pad(c, (0, len(self.words) + 1 - len(c)))[1:] for c in self.counts]

    def count(self, which: int, numbers: np.ndarray) -> None:
        new = np.bincount(numbers, minlength=len(self.words) + 1)
        new[:len(self.counts[which])] += self.counts[which]
        self.counts[which] = new

    def by_group(self) -> Iterator[tuple[str, np.ndarray]]:
        """Each group's numbers."""
        for group in dict.fromkeys(g for g, _, _ in self.groups):
            yield group, np.concatenate([np.arange(lo, hi + 1, dtype="u4") for g, lo, hi in self.groups if g == group])


def slice_number(nth: int) -> int:
    """A number of its own for every slice of a table that is written once."""
    return (TaskContext.get().partitionId() << 24) + nth


def chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in byte_slices(batch.column(column), CHUNK_BYTES):
            yield batch.slice(lo, hi - lo)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a row is a whole slice."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def bucketed(keys: np.ndarray, buckets: int, hashed: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """Places of keys by bucket; those that are hashes already are cut by their range, so that they lie close in a block."""
    where = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) if hashed else mixed(keys) % np.uint64(buckets)).astype("i8")
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(buckets + 1))
    for b in range(buckets):
        if cuts[b + 1] > cuts[b]:
            yield b, order[cuts[b]:cuts[b + 1]]


def added_up(blocks: DataFrame, counts: list[str], reply: Callable[[list, pa.Array, list[np.ndarray], list[np.ndarray]], Iterator[dict]], schema: str, words: bool = False, by: tuple[str, ...] = ("bucket",)) -> DataFrame:
    """Add up the blocks ``<by>, slice, keys, <counts>`` of each bucket and let ``reply`` say what goes out.

    ``reply`` gets the blocks' rows, the bucket's distinct keys (``words``: the words), where each block's
    keys are among them, and the sums.
    """
    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        if words:
            keys = [unpacked_words(r["keys"]).split(b"\n") for r in rows]
            coded = pa.array([w for k in keys for w in k], pa.binary()).dictionary_encode()
            distinct, which = coded.dictionary, coded.indices.to_numpy()
        else:
            keys = [unpacked_sorted(r["keys"]) for r in rows]
            every = np.concatenate(keys)
            order = np.argsort(every, kind="stable")
            in_order = every[order]
            head = np.diff(in_order, prepend=in_order[:1] - np.uint64(1)) != 0
            which = np.empty(len(every), "i4")
            which[order] = np.cumsum(head, dtype="i4") - 1
            distinct = in_order[head]
            del every, order, in_order, head
        sums = [np.bincount(which, np.concatenate([unpacked(r[c], "u4") for r in rows]), len(distinct)).astype("i8") for c in counts]
        places = np.split(which, np.cumsum([len(k) for k in keys])[:-1])
        out = pa.Table.from_pylist(list(reply(rows, distinct, places, sums)), wire)
        give_back()
        return out

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wire = to_arrow_schema(StructType.fromDDL(schema))
    return blocks.groupBy(*by).applyInArrow(merge, schema)


def ranked(df: DataFrame, name: str, *order) -> tuple[DataFrame, int]:
    """``df`` with ``id``: 1, 2, ... in the given order; and the number of rows.

    A distributed sort is written with each row's place in its partition, and shifted
    by the rows of the partitions before: one number a partition reaches one task.
    """
    placed = stored(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n")).collect()  # one row a partition of the sort
    before, base = 0, {}
    for p, n in sorted((r["__part"], r["__n"]) for r in sizes):
        base[p], before = before, before + n
    bases = df.sparkSession.createDataFrame(list(base.items()) or [(0, 0)], "__part long, __base long")
    numbered = placed.withColumn("__part", part).join(F.broadcast(bases), "__part").withColumn(
        "id", F.col("__base") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1)
    return numbered.drop("__part", "__base", "__at"), before
