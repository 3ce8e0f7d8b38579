"""Exact top-k by inner product over an index of pivots and distances.

Vectors are turned into whole numbers (``floor(256 x)``).  Pivots are spread
over a bounded sample, farthest first.  Every vector is keyed by its nearest
pivot and its distance r from it; rows sorted by that key are cut into annuli,
blocks of neighbouring distances around one pivot with the smallest and largest
r and the largest length in them.

For a query q at distance s from the pivot p, the triangle inequality puts every
vector of an annulus at least ``gap`` = the distance of s from [r_low, r_high]
away, so ``2 q.x = |q|^2 + |x|^2 - |q - x|^2 <= |q|^2 + L^2 - gap^2``; and
``q.x <= q.p + |q| r_high``.  A query starts from the k-th best score of the
sample; queries are blocked by their nearest pivot, and an annulus meets a block
only if the bound for all of its queries, from their smallest and largest s,
allows it.  Within a pair a query is passed over if its own bound is below what
it has, the others raise it.  Nothing within the bound is left out, so the
result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import stored
from tallyframe.llm.vectors import INDEX_VALUES, QUERY_VALUES, Reached, best, matrix, met, one_each, ranked, sample_of, searched, unpacked, valid_vectors

SCALE, PIVOTS = 256, 32
#: Blocks that a sorted part of the index is cut into, at the least, and parts of a small index.
PART_BLOCKS, FEW_PARTS = 16, 24


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def spread_pivots(x: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows of the sample, each the farthest from those before."""
    chosen, gap = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and gap.max() > 0:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares, own = (x * x).sum(1), (pivots * pivots).sum(1)
    if squares.max(initial=0) + own.max(initial=0) < 2 ** 50:  # whole numbers: exact
        return np.sqrt(squares[:, None] + own - 2 * (x @ pivots.T))
    return np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in pivots], 1))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in floats while they hold every sum, else in Python's integers.

    No sum of some of the terms is beyond the product of the lengths.
    """
    def length(v: np.ndarray) -> float:
        wide = v.astype("f8")
        return float(np.sqrt((wide * wide).sum(1).max(initial=0))) * (1 + 1e-9) + 1

    most = length(q) * length(x)
    if most < 2 ** 52:
        kind = "f4" if most < 2 ** 24 else "f8"
        return q.astype(kind) @ x.astype(kind).T
    exact = np.vectorize(int, otypes=[object])
    return exact(q).dot(exact(x).T) if len(q) and len(x) else np.empty((len(q), len(x)), object)


def upper_bounds(q: np.ndarray, pivot: np.ndarray, low: float, high: float, length: float) -> np.ndarray:
    """No vector of the annulus has a higher inner product with the query (rounding allowed for)."""
    size, s = np.sqrt((q * q).sum(1)), np.sqrt(((q - pivot) ** 2).sum(1))
    gap = np.maximum(np.maximum(low - s, s - high), 0)
    by_distance = (size ** 2 + length ** 2 - gap ** 2) / 2
    by_pivot = q @ pivot + size * high
    slack = 1e-9 * (size ** 2 + length ** 2 + (pivot ** 2).sum() + high ** 2) + 1
    return np.minimum(by_distance, by_pivot) + slack


def below(score: np.ndarray) -> np.ndarray:
    """Scores as floats that are surely no higher."""
    return score - np.abs(score) * 1e-12


def at_least(score: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where whole scores (by query) reach ``least``, as places in the flat table."""
    bar = np.ceil(least)
    if score.dtype == "f4":  # which holds these scores, but not every bar
        bar = np.clip(bar, -2.0 ** 24, 2.0 ** 24).astype("f4")
    return np.flatnonzero(score >= bar[:, None])


def _annuli(keyed: DataFrame, d: int, kind: str) -> DataFrame:
    """Blocks of neighbouring rows of one pivot, from rows in order of pivot and distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pivot, r, x = np.empty(0, "i8"), np.empty(0, "i4"), np.empty(0), np.empty((0, d), kind)
        rows = max(1, INDEX_VALUES // d)

        def cut(end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, pivot, r, x
            while len(ids) and (end or len(ids) >= rows):
                n = min(rows, int(np.searchsorted(pivot, pivot[0], "right")))
                v = x[:n].astype("f8")
                yield pa.RecordBatch.from_pylist([{
                    "pivot": int(pivot[0]), "low": float(r[0]), "high": float(r[n - 1]), "length": float(np.sqrt((v * v).sum(1).max())),
                    "ids": ids[:n].tobytes(), "vector": x[:n].tobytes()}], shape)
                ids, pivot, r, x = ids[n:], pivot[n:], r[n:], x[n:]

        for batch in batches:
            ids, pivot, r = (np.concatenate([a, batch.column(c).to_numpy()]) for a, c in ((ids, "id"), (pivot, "pivot"), (r, "r")))
            x = np.concatenate([x, rows_of(batch.column("vector"), d, kind)])
            yield from cut(False)
        yield from cut(True)

    shape = pa.schema([("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("length", pa.float64()), ("ids", pa.binary()), ("vector", pa.binary())])
    return keyed.mapInArrow(run, "pivot int, low double, high double, length double, ids binary, vector binary")


def rows_of(column: pa.Array, d: int, kind: str) -> np.ndarray:
    """Vectors that came packed, one by one."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)


def _query_blocks(keyed: DataFrame, pivots: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int, d: int, kind: str) -> DataFrame:
    """Blocks of queries of one pivot: what they have of the sample, and over all of them the least of it, the largest length and the range of s by pivot."""
    share = keyed.groupBy("pivot").count()
    parts = F.ceil(F.col("count") * d / QUERY_VALUES).cast("int")
    dealt = keyed.join(F.broadcast(share.select("pivot", parts.alias("parts"))), "pivot").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    shape = pa.schema([("qid", pa.binary()), ("qvector", pa.binary()), ("have", pa.binary()), ("size", pa.float64()), ("least", pa.float64()),
                       ("near", pa.list_(pa.float64())), ("far", pa.list_(pa.float64()))])

    def pack(group: pa.Table) -> pa.Table:
        ids, x = group.column("id").to_numpy().astype("i8"), rows_of(group.column("vector").combine_chunks(), d, kind)
        have, s, wide = start(ids, x, sample_ids, sample, k), distances(x.astype("f8"), pivots), x.astype("f8")
        return pa.Table.from_pylist([{
            "qid": ids.tobytes(), "qvector": x.tobytes(), "have": have.tobytes(), "size": float(np.sqrt((wide * wide).sum(1).max())), "least": float(have.min()),
            "near": s.min(0).tolist(), "far": s.max(0).tolist()}], shape)

    return dealt.select("pivot", "part", "id", "vector").groupBy("pivot", "part").applyInArrow(
        pack, "qid binary, qvector binary, have binary, size double, least double, near array<double>, far array<double>")


def start(qid: np.ndarray, q: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score in the sample, which the whole table cannot miss."""
    scores = products(q, sample).astype("f8")
    scores[qid[:, None] == sample_ids[None, :]] = -np.inf
    return below(np.sort(scores, axis=1)[:, -k]) if scores.shape[1] >= k else np.full(len(q), -np.inf)


def _may_hold() -> Column:
    """Whether ``upper_bounds`` of the annulus may reach ``least`` for a query of the block: in numbers only, before the vectors move."""
    near, far = (F.element_at(c, F.col("pivot") + 1) for c in ("near", "far"))
    gap = F.greatest(F.lit(0.0), F.col("low") - far, near - F.col("high"))
    squares = F.col("size") * F.col("size") + F.col("length") * F.col("length")
    slack = 1e-9 * (squares + far * far + F.col("high") * F.col("high")) + 1
    return ~((squares - gap * gap) / 2 + slack < F.col("least"))


def _search(pivots: np.ndarray, k: int, d: int):
    asked: dict[bytes, Reached] = {}

    def run(qid: bytes, qvector: bytes, have: bytes, pivot: int, low: float, high: float, length: float, ids: bytes, vector: bytes) -> tuple:
        queries, ids = np.frombuffer(qid, "i8"), np.frombuffer(ids, "i8")
        kind = "i" if len(qvector) == 2 * d * len(queries) else "f"
        q, x = unpacked(qvector, len(queries), d, kind), unpacked(vector, len(ids), d, kind)
        if qid not in asked:
            if len(asked) >= 256:
                asked.clear()
            asked[qid] = Reached(queries, k, np.frombuffer(have, "f8"))
        reached = asked[qid]
        open_ = np.flatnonzero(~(upper_bounds(q.astype("f8"), pivots[pivot], low, high, length) < reached.least))
        score = products(q[open_], x)
        found = at_least(score, reached.least[open_])
        i, j = np.divmod(found, max(1, len(ids)))
        score, other = score.ravel()[found].astype("i8"), queries[open_[i]] != ids[j]
        query, near, value = best(queries[open_[i[other]]], ids[j[other]], score[other], k)
        reached.add(query, below(value.astype("f8")))
        return query, near, value

    return run


def top_products(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of ``floor(256 x)`` vectors.

    Queries are the rows whose id ``every`` divides; a row is no answer to its
    own id; ties go to the smaller id.  Rows of one id are one row (the smallest
    vector).  Vectors that are null, of another dimension than most, or hold
    null or non-finite components take no part, nor do rows without id; zero
    vectors do.  A score beyond a long is an error.
    """
    vectors = stored(one_each(valid_vectors(df, id_col, vector_col)), "vectors")
    rows, most = vectors.agg(F.count("id"), F.max(F.greatest(F.array_max("vector"), -F.array_min("vector")))).first()
    if not rows:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ids, sample = sample_of(vectors, rows)
    d, sample = sample.shape[1], whole(sample)
    pivots = spread_pivots(sample)
    kind = "i2" if SCALE * most + 1 < 2 ** 15 else "f4" if SCALE * most + 1 < 2 ** 24 else "f8"

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column("vector")))
            apart = distances(x, pivots)
            nearest, size = apart.argmin(1), d * np.dtype(kind).itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype="i4") * np.int32(size)), pa.py_buffer(x.astype(kind).tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nearest.astype("i4")), pa.array(apart[np.arange(len(x)), nearest]), packed], names=["id", "pivot", "r", "vector"])

    def keyed(some: DataFrame) -> DataFrame:
        return some.mapInArrow(key, "id long, pivot int, r double, vector binary")

    blocks = -(-rows * d // INDEX_VALUES)
    in_order = keyed(vectors).repartitionByRange(max(min(blocks, FEW_PARTS), -(-blocks // PART_BLOCKS)), "pivot", "r", "id").sortWithinPartitions("pivot", "r", "id")
    annuli = stored(_annuli(in_order, d, kind), "annuli")
    asked = stored(keyed(vectors.where(F.col("id") % every == 0)), "asked")
    queries = stored(_query_blocks(asked, pivots, ids, sample, k, d, kind), "queries")
    columns = ["qid", "qvector", "have", "pivot", "low", "high", "length", "ids", "vector"]
    return ranked(searched(met(queries, annuli, asked.count() * d, _may_hold()), columns, _search(pivots, k, d), "long"), k)
