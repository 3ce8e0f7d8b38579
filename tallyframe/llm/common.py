"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import checkpoint_dir


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage: whatever is built on the result re-reads files that every
    executor can reach, so a lost executor costs its own tasks only, and
    numbering done by partition stays as it was written.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of an installed public tokenizer file (a parameter everywhere else)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text (a longer row is alone)."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("i8"))
    lo = 0
    while lo < len(upto):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


#: Places of a mark table: 64 to a row, so at most 262,144 rows are sent to the executors, however many keys there are.
MARK_BITS = 1 << 24


def marked(df: DataFrame, key: Column, members: DataFrame, member: Column, out: str) -> DataFrame:
    """``df`` with ``out``: false only if ``key`` is surely none of the members.

    A table of bits of bounded size (a Bloom filter of one hash) that saves rows
    that need no join from being shuffled for one.  With very many members it says
    true more often and saves less, the answer of the join behind it stays.
    """
    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(MARK_BITS))

    bit = F.expr("shiftleft(1L, cast(pmod(__mark, 64) as int))")
    words = members.select(place(member).alias("__mark")).groupBy(F.expr("__mark div 64").alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    known = df.withColumn("__mark", place(key)).join(F.broadcast(words), F.expr("__mark div 64") == F.col("__word"), "left")
    return known.withColumn(out, F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).drop("__mark", "__word", "__bits")


def give_back() -> None:
    """Return a finished task's freed memory to the system: Python workers live on, two and more to an executor."""
    import ctypes
    import ctypes.util

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    if libc and hasattr(trim := ctypes.CDLL(libc), "malloc_trim"):
        trim.malloc_trim(0)
