"""Packing by concatenate and cut.

All documents stand behind one another in one stream of ids that is cut every
``length`` ids.  Two passes make it parallel: the first tokenises each input
partition once, writes the ids with their place inside the partition, and the
partition totals; prefix sums over the totals give each partition its place in
the stream.  The second cuts every document at the windows' borders by itself;
no ids are shuffled.  Only the last sequence is not full.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import give_back, stored

END_ID = 1
LENGTH = 2048
TABLE_WORDS = 150_000
SLICE_BYTES = 8 << 20
#: One row of 16 bytes for each input partition; beyond it the offsets are joined by a shuffle.
MOST_BROADCAST_PARTITIONS = 1_000_000

_LATIN_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_STOPS = ".,!?;:"


class WordTable:
    """Ids of texts through their distinct space-delimited chunks.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its chunks' ids in order.  Each distinct chunk of a slice of texts is
    encoded once and its ids are gathered back by position.  A chunk that is a
    plain Latin word with stops behind it goes straight to the vocabulary's
    merges, which a bounded table of lower-cased words saves from batch to
    batch; any other goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.merges = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.words: dict[str, bytes] = {}

    def _merged(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            symbols = word if word.isascii() else word.translate(self.bytes)
            got = self.words[word] = array("I", [t.id for t in self.merges.tokenize(symbols)]).tobytes()
        return got

    def _whole(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _chunks(self, chunks: pa.StringArray) -> list[bytes]:
        if len(self.words) > TABLE_WORDS:
            self.words = {}
        words = pc.utf8_rtrim(chunks, characters=_STOPS)
        plain = pc.match_substring_regex(words, _LATIN_WORD)
        lower = pc.utf8_lower(words.filter(plain)).dictionary_encode()
        merged = [self._merged(w) for w in lower.dictionary.to_pylist()]
        found = iter([merged[i] for i in lower.indices.to_numpy().tolist()])
        ids = [next(found) if p else b"" for p in plain.to_pylist()]
        stops = pc.less(pc.binary_length(words), pc.binary_length(chunks)).to_numpy(zero_copy_only=False)
        plain = plain.to_numpy(zero_copy_only=False)
        for i, word, chunk in _picked(plain & stops, words, chunks):
            ids[i] += self._merged(chunk[len(word):])
        for i, chunk in _picked(~plain, chunks):
            ids[i] = self._whole(chunk)
        return ids

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Every text's ids with ``end_id`` behind them: their counts, and all ids in one array."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        by_chunk = self._chunks(coded.dictionary)
        size = np.fromiter(map(len, by_chunk), "i4", len(by_chunk)) // 4
        table, first = np.frombuffer(b"".join(by_chunk), "<u4"), np.cumsum(size, dtype="i4") - size
        n = size[which]
        upto = np.zeros(len(n) + 1, "i8")
        np.cumsum(n, out=upto[1:])
        at = np.repeat(first[which] - upto[:-1].astype("i4"), n)  # 32 bits: a slice is far below 2^31 ids
        at += np.arange(len(at), dtype="i4")
        ends = upto[bounds]
        return np.diff(ends) + 1, np.insert(table[at], ends[1:], np.uint32(end_id)).astype("<u4", copy=False)


@functools.cache
def _table(tokenizer_path: str) -> WordTable:
    """One table for all tasks of a Python worker."""
    return WordTable(tokenizer_path)


def _picked(mask: np.ndarray, *arrays: pa.Array) -> Iterator[tuple]:
    at = np.flatnonzero(mask)
    return zip(at.tolist(), *(a.take(pa.array(at)).to_pylist() for a in arrays))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_BYTES`` of text (a longer row is alone)."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
    lo = 0
    while lo < len(upto):
        done = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, done + SLICE_BYTES, "right")))
        yield lo, hi
        lo = hi


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: ``id_col, part, before, n, ids`` (uint32 bytes with ``end_id`` last).

    ``before`` counts the ids that stand before the document in its partition.
    """
    narrow = docs.select(id_col, text_col)
    id_type = narrow.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before, part = _table(tokenizer_path), 0, TaskContext.get().partitionId()
        for batch in batches:
            for lo, hi in _slices(batch.column(1)):
                some = batch.slice(lo, hi - lo)
                n, ids = table.encode(some.column(1), end_id)
                upto = np.concatenate(([0], np.cumsum(n)))
                starts, before = before + upto[:-1], before + int(upto[-1])
                packed = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(4 * upto), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(n), part, "int32")), pa.array(starts), pa.array(n), packed],
                    names=[id_col, "part", "before", "n", "ids"])
        give_back()

    return narrow.mapInArrow(run, f"`{id_col}` {id_type}, part int, before long, n long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian uint32.  Every id of every
    document lies in exactly one piece; a null or empty text is its end id
    alone.  Repeated rows are packed as often as they stand there; an empty
    table gives no piece.  All sequences but the last are full.
    """
    tokens = stored(tokenised(docs, tokenizer_path, end_id, id_col, text_col), "tokens", "zstd")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    place = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("at_part"), F.coalesce(F.sum("total").over(place), F.lit(0)).alias("base"))
    if tokens.select("part").distinct().count() <= MOST_BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    placed = tokens.join(offsets, F.col("part") == F.col("at_part")).select(
        id_col, (F.col("base") + F.col("before")).alias("at"), "n", "ids")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                at, n, ids = some.column(1).to_numpy(), some.column(2).to_numpy(), some.column(3).to_pylist()
                first = at // length
                pieces = (at + n - 1) // length - first + 1
                row = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = first[row] + nth
                start = np.maximum(sequence * length, at[row])
                stop = np.minimum((sequence + 1) * length, (at + n)[row])
                inside = start - at[row]
                cut = [ids[r][4 * a:4 * b] for r, a, b in zip(row.tolist(), inside.tolist(), (stop - at[row]).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(row)), pa.array(inside), pa.array(stop - start), pa.array(cut, pa.binary()),
                     pa.array(n[row]), pa.array(sequence), pa.array(start - sequence * length)],
                    names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
