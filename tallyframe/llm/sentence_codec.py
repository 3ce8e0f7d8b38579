"""SentencePiece encoding and decoding through a table of distinct chunks.

A model none of whose pieces has a whitespace marker behind another character
can never build a piece across the start of a marked word.  A text is then the
sequence of its chunks (a run of spaces and the word behind it), and encoding
the text is encoding each chunk: every distinct chunk is segmented once into a
table and the ids are joined back by the chunk's position.

The table lives in the task that reads the texts and is emptied between
batches once it holds ``TABLE_CHUNKS`` chunks, so memory is bounded and the
texts are never shuffled.  (One table for the whole corpus would need every
occurrence of every word shuffled with its position, several times the input.)
A model that allows pieces across markers, or a text that holds the marker
character itself, is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARKER = "▁"
TABLE_CHUNKS = 300_000
_CHUNK = re.compile(" +[^ ]*")


def markers_bound_pieces(processor) -> bool:
    """True when no piece of the model continues over a whitespace marker."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    return not any(MARKER in piece.lstrip(MARKER) for piece in pieces)


def chunks(text: str) -> list[str]:
    """The text's chunks, each without its first space (the encoder adds one)."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _CHUNK.findall(" " + text)]
    return text.split(" ")


class ChunkTable:
    """Distinct chunk -> ids, each segmented once."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.splits = markers_bound_pieces(self.processor)
        letter = self.processor.encode("a")
        self.bare = {"": self.processor.encode("a ")[len(letter):]}  # a single space with no word behind it
        self.ids: dict[str, list[int]] = dict(self.bare)

    def encode(self, texts: list[str]) -> list[list[int]]:
        by_chunk = [chunks(t) if self.splits and MARKER not in t else None for t in texts]
        if len(self.ids) > TABLE_CHUNKS:
            self.ids = dict(self.bare)
        table = self.ids
        new = list(set().union(*(c for c in by_chunk if c)).difference(table))
        table.update(zip(new, self.processor.encode(new, num_threads=1)))
        out = []
        for text, parts in zip(texts, by_chunk):
            if parts is None:
                out.append(self.processor.encode(text))
            else:
                ids: list[int] = []
                for part in parts:
                    ids += table[part]
                out.append(ids)
        return out


def _slices(texts: list[str], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most_chars`` characters (a longer row is alone)."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``ids array<int>``, ``decoded string``.

    ``ids`` are exactly what the library gives for the whole text without begin
    or end ids and without sampling; ``decoded`` is its ``decode(ids)``.  A null
    or empty text has no ids and decodes to the empty text.  Repeated rows and
    null ids are kept as they are; other columns are not read.
    """
    narrow = docs.select(id_col, text_col)
    id_type = narrow.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _slices(texts):
                ids = table.encode(texts[lo:hi])
                decoded = [table.processor.decode(i) if i else "" for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                    names=[id_col, "ids", "decoded"])

    return narrow.mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>, decoded string")
