"""Vectors in blocks: what the two vector searches share.

A block is one row that holds the ids and vectors of some rows as packed
arrays.  Both sides are written once; a search reads every part of the index
beside every part of the queries (a product of two scans: nothing is repeated,
shuffled or broadcast for it), so neither the driver nor a disk holds pairs of
blocks, and a task holds two bounded blocks whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tallyframe.llm.common import give_back, stored

SAMPLE_ROWS = 4096
#: Components of a block: 2,048 rows of the index and 1,024 queries of 64 dimensions.
INDEX_VALUES, QUERY_VALUES = 1 << 17, 1 << 16
#: Components of the queries that a task has beside its part of the index.
PART_VALUES = 1 << 22
#: The index is read in as many parts, or four to each core if these are more: a query has k rows of each to be ranked.
INDEX_PARTS = 64


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (``array<float>`` if they were given so, else ``array<double>``) of rows with an id and a vector without null or non-finite components.

    Vectors have the dimension that most have (of two, the smaller); others
    take no part.
    """
    given = df.schema[vector_col].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    finite = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("vector") > 0))
    most = finite.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return finite.where(F.size("vector") == (most[0].d if most else 0))


def one_each(vectors: DataFrame) -> DataFrame:
    """One row for each id: of several the one with the smallest vector."""
    return vectors.groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return flat.reshape(len(column), -1)


def unpacked(packed: bytes, rows: int, d: int, kind: str = "f") -> np.ndarray:
    """Rows of ``d`` numbers, of the size that the bytes tell (``kind``: f floats, u unsigned)."""
    return np.frombuffer(packed, f"{kind}{len(packed) // max(1, rows * d)}").reshape(rows, d)


def sample_of(vectors: DataFrame, count: int, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded sample, the lowest hashes of the id; only rows of low hash are sorted for it."""
    def lowest(some: DataFrame) -> pa.Table:
        return some.orderBy(F.xxhash64("id"), "id", "vector").limit(rows).toArrow()

    got = lowest(vectors.where(F.xxhash64("id") < (rows * 2 ** 65 // count) - 2 ** 63)) if count > 8 * rows else None
    if got is None or len(got) < rows:
        got = lowest(vectors)
    return got.column("id").to_numpy(), matrix(got.column("vector").combine_chunks()) if len(got) else np.empty((0, 0))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of ``rows`` rows at a time, however the batches are cut."""
    ids, x = [], []

    def cut(end: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if sum(map(len, ids)) >= (1 if end else rows):
            i, v = np.concatenate(ids), np.concatenate(x)
            whole = len(i) if end else len(i) // rows * rows
            yield from ((i[lo:min(lo + rows, whole)], v[lo:min(lo + rows, whole)]) for lo in range(0, whole, rows))
            ids[:], x[:] = [i[whole:]], [v[whole:]]

    for batch in batches:
        ids.append(batch.column("id").to_numpy())
        x.append(matrix(batch.column("vector")))
        yield from cut(False)
    yield from cut(True)


def met(queries: DataFrame, index: DataFrame, values: int, only: Column | None = None, once: tuple[list[str], list[str]] = ([], [])) -> DataFrame:
    """Every block of queries (``values`` components in all) beside every block of the index, or those pairs that ``only`` holds for.

    Tasks read their parts of both tables; the queries' part is kept for the blocks of the index.
    ``once``: columns of the queries that a task is told only beside its first
    block of the index, and of the index only beside its first block of
    queries; they are null in its other pairs.
    """
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2 ** 33 - 1)) == 0  # of the part
    context = index.sparkSession.sparkContext
    index = index.coalesce(max(INDEX_PARTS, 4 * context.defaultParallelism)).withColumn("__block", first).hint("shuffle_replicate_nl")
    queries = queries.coalesce(max(1, -(-values // PART_VALUES))).withColumn("__queries", first)
    pairs = index.crossJoin(queries) if only is None else index.join(queries, only)
    told = {c: F.when(F.col(of), F.col(c)) for of, columns in zip(("__block", "__queries"), once, strict=True) for c in columns}
    return pairs.withColumns(told).drop("__block", "__queries") if told else pairs.drop("__block", "__queries")


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    new = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.empty(0, int)
    nth = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
    return query[nth < k], ids[nth < k], score[nth < k]


class Reached:
    """The k best scores so far of some queries; a row that scores less than the worst of them is no answer."""

    def __init__(self, queries: np.ndarray, k: int, start: np.ndarray | None = None):
        self.order = np.argsort(queries)
        self.queries, self.k = queries[self.order], k
        self.top = np.full((len(queries), k), -np.inf)
        self.least = np.full(len(queries), -np.inf) if start is None else start.copy()

    def add(self, query: np.ndarray, score: np.ndarray) -> None:
        """Scores that ``best`` gave (``query`` in order, each row of the index once)."""
        if len(query):
            new = np.concatenate(([True], query[1:] != query[:-1]))
            at = self.order[np.searchsorted(self.queries, query[new])]
            more = np.full((len(at), self.k), -np.inf)
            more[np.cumsum(new) - 1, np.arange(len(query)) - np.flatnonzero(new)[np.cumsum(new) - 1]] = score
            self.top[at] = np.sort(np.concatenate([self.top[at], more], 1), axis=1)[:, self.k:]
            self.least[at] = np.maximum(self.least[at], self.top[at, 0])


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` from candidates; Spark cuts each task's rows to k a query before they are shuffled."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def searched(pairs: DataFrame, columns: list[str], search: Callable[..., tuple], score_type: str) -> DataFrame:
    """``query_id, vec_id, score`` of ``search`` run on each pair of blocks."""
    kind = {"double": pa.float64(), "long": pa.int64()}[score_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query, ids, score = search(*(batch.column(c)[i].as_py() for c in columns))
                if len(query):
                    yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(score, kind)], names=["query_id", "vec_id", "score"])
        give_back()

    return pairs.select(*columns).mapInArrow(run, f"query_id long, vec_id long, score {score_type}")


__all__ = ["INDEX_VALUES", "QUERY_VALUES", "Reached", "best", "matrix", "met", "one_each", "ranked", "sample_of", "searched", "slices", "stored", "unpacked", "valid_vectors"]
