"""Document sinks: one pretty JSON document per record, and JSON array files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyframe.operators.records import pretty_json


def write_json_documents(df: DataFrame, path: str, indent: int = 2) -> None:
    """Write each row as an indented JSON document (``json.dumps(..., indent=2)``
    layout), one document per text record, replacing ``path``."""
    df.select(pretty_json(df, indent).alias("value")).write.mode("overwrite").option(
        "lineSep", "\n\n").text(path)


def write_arrays(df: DataFrame, path: str, col: str = "value") -> None:
    """JSON array files, one for each partition of ``df``: its records' JSON texts, in order, one a line."""
    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            if batch.column(0).null_count:
                raise ValueError("a record has no JSON text")
            for part in (batch.slice(0, 1), batch.slice(1)):
                if len(part):
                    yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(mark, part.column(0), "")], names=["value"])
                    mark = ","
        yield pa.RecordBatch.from_pylist([{"value": "]" if mark == "," else "[]"}])

    df.select(col).mapInArrow(bracketed, "value string").write.mode("overwrite").text(path)
