"""Approximate nearest neighbours by multi-index hashing of binary codes.

Rotations learnt on a bounded sample (iterative quantisation: codes and rotation
are fitted to one another in turns) turn a direction into a code of ``BITS``
bits.  Codes are split into bytes, and each byte position is an index of its
own: rows by byte value.  Two codes within Hamming radius r agree in some byte
up to that byte's share of r (pigeonhole: the shares plus one add up to r + 1),
so looking up, for every byte of the query, the values within its share finds
every code within r.  Those are reranked by the exact cosine of the original
vectors.  r is learnt too: the radius within which ``COVERED`` of the sample's
own neighbours lie; neighbours in the whole table are nearer than in a sample.

All rows are indexed, in blocks, and a block's buckets are bitmaps of its rows:
those within a byte's share of a value are the value's bitmap and those of the
values around it put together, once for all queries.  A query that finds too few
within r is searched again with the full radius, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tallyframe.llm.common import stored
from tallyframe.llm.vectors import INDEX_VALUES, QUERY_VALUES, Reached, best, matrix, met, one_each, ranked, sample_of, searched, slices, unpacked, valid_vectors

BITS, COVERED, ROUNDS = 128, 0.98, 15
#: Pairs whose products are computed at once; pairs of one query from which on they are computed as its own product.
PAIRS, RUN = 4096, 16
#: Queries whose codes are compared with a block's at once, and the share of pairs found above which this is done for all of them.
TOGETHER, DENSE = 8, 1 / 16
_ONES = np.array([bin(i).count("1") for i in range(256)], "u1")


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def learn_rotations(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Columns that give the bits: rotations of the sample's main directions, fitted in turns with its codes."""
    rnd, d = np.random.default_rng(7), x.shape[1]
    width = min(d, bits)
    _, axes = np.linalg.eigh(x.T @ x)
    main = axes[:, ::-1][:, :width]
    projected, out = x @ main, []
    for _ in range(-(-bits // width)):
        rotation, _ = np.linalg.qr(rnd.standard_normal((width, width)))
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(projected.T @ np.where(projected @ rotation >= 0, 1.0, -1.0))
            rotation = u @ v
        out.append(main @ rotation)
    return np.hstack(out)[:, :bits]


def codes(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    return np.packbits(x @ rotations >= 0, axis=1)


def shares(radius: int, bytes_: int) -> np.ndarray:
    """Radius of each byte; one of them holds for any two codes within ``radius``."""
    return (radius + 1) // bytes_ - 1 + (np.arange(bytes_) < (radius + 1) % bytes_)


def learn_radius(x: np.ndarray, rotations: np.ndarray, k: int) -> int:
    queries = x[:256]
    cosine = queries @ x.T
    cosine[np.arange(len(queries)), np.arange(len(queries))] = -2
    nearest = np.argsort(-cosine, axis=1)[:, :min(k, len(x) - 1)]
    code = codes(x, rotations)
    apart = _ONES[code[:len(queries), None, :] ^ code[nearest]].sum(2)
    return int(np.quantile(apart, COVERED, method="higher")) if apart.size else rotations.shape[1]


def bucket_rows(code: np.ndarray) -> np.ndarray:
    """For every byte position the rows in order of its value."""
    return np.argsort(code, axis=0, kind="stable").T.astype("u2" if len(code) <= 1 << 16 else "u4")


def products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of row i of q and row j of x, pair by pair (i in order)."""
    if 2 * len(i) > len(q) * len(x):  # as with the full radius: cheaper all at once
        return (q @ x.T)[i, j]
    out = np.empty(len(i), q.dtype)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(i)) + 1, [len(i)]))
    if len(i) >= RUN * (len(cuts) - 1):
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[lo:hi] = x[j[lo:hi]] @ q[i[lo]] if hi > lo else 0
    else:
        for lo in range(0, len(i), PAIRS):
            out[lo:lo + PAIRS] = np.einsum("ij,ij->i", q[i[lo:lo + PAIRS]], x[j[lo:lo + PAIRS]])
    return out


def words(code: np.ndarray) -> np.ndarray:
    """Codes as whole numbers of eight bytes, a row for each place."""
    width = -(-code.shape[1] // 8) * 8
    return np.ascontiguousarray(np.pad(code, ((0, 0), (0, width - code.shape[1]))).view("u8").T)


class CodeIndex:
    """One block's codes by byte position and value; ``rows`` is their order as ``bucket_rows`` gave it."""

    def __init__(self, code: np.ndarray, rows: np.ndarray | None = None):
        self.code = code
        self.rows = bucket_rows(code) if rows is None else rows
        self.bounds = [np.concatenate(([0], np.cumsum(np.bincount(code[:, j], minlength=256)))) for j in range(code.shape[1])]
        self.words = words(code)
        self.balls: dict[tuple[int, int], np.ndarray] = {}

    def around(self, j: int, share: int) -> np.ndarray:
        """By value of byte ``j``, as bits: rows whose byte is at most ``share`` bits from it."""
        if (j, share) not in self.balls:
            member = np.zeros((256, len(self.code)), bool)
            member[np.repeat(np.arange(256), np.diff(self.bounds[j])), self.rows[j]] = True
            ball = np.packbits(member, axis=1)
            for _ in range(min(share, 8)):
                inner, ball = ball, ball.copy()
                for bit in range(8):
                    ball |= inner[np.arange(256) ^ (1 << bit)]
            self.balls[j, share] = ball
        return self.balls[j, share]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Query by row: codes at most ``radius`` apart, found through the bytes' buckets."""
        if radius >= 8 * self.code.shape[1]:
            return np.ones((len(query), len(self.code)), bool)
        probed = np.zeros((len(query), -(-len(self.code) // 8)), "u1")
        for j, share in enumerate(shares(radius, self.code.shape[1]).tolist()):
            if share >= 0:
                probed |= self.around(j, share)[query[:, j]]
        found = np.unpackbits(probed, axis=1, count=len(self.code)).view(bool)
        if np.count_nonzero(found) > DENSE * found.size:
            mine, kind = words(query), "u1" if self.code.shape[1] < 32 else "u4"
            for lo in range(0, len(query), TOGETHER):
                apart = sum(np.bitwise_count(a[lo:lo + TOGETHER, None] ^ b).astype(kind, copy=False) for a, b in zip(mine, self.words, strict=True))
                found[lo:lo + TOGETHER] &= apart <= radius
        else:
            q, row = np.nonzero(found)
            far = _ONES[query[q] ^ self.code[row]].sum(1) > radius
            found[q[far], row[far]] = False
        return found


def _search(rotations: np.ndarray, radius: int, k: int, d: int):
    asked: dict[bytes, tuple] = {}  # the task's blocks of queries
    block: list = [b""]  # the block of the index, which meets them one after the other
    slack = (d + 8) * 2.0 ** -22  # of products in single precision

    def run(qid: bytes, qvector: bytes | None, ids: bytes, vector: bytes | None, code: bytes | None, rows: bytes | None) -> tuple:
        """Only the numbers of a block that the task has met already may come without the rest."""
        n = len(ids) // 8
        if qid not in asked:
            if qvector is None:
                raise RuntimeError("queries that were not told")
            queries, q = np.frombuffer(qid, "i8"), unpacked(qvector, len(qid) // 8, d)
            direction = unit(q.astype("f8"))
            asked[qid] = queries, q, codes(direction, rotations), direction.astype("f4"), Reached(queries, k)
        queries, q, qcode, qunit, reached = asked[qid]
        if block[0] != ids:
            if vector is None:
                raise RuntimeError("a block of the index that was not told")
            x, known = unpacked(vector, n, d), unpacked(code, n, len(code) // n, "u")
            index = CodeIndex(known, unpacked(rows, known.shape[1], n, "u"))
            numbers = np.frombuffer(ids, "i8")
            block[:] = ids, numbers, np.argsort(numbers), index, x, unit(x.astype("f8")).astype("f4")
        _, ids, order, index, x, xunit = block
        found = index.within(qcode, radius)
        own = order[np.minimum(np.searchsorted(ids, queries, sorter=order), n - 1)]
        mine = np.flatnonzero(ids[own] == queries)
        found[mine, own[mine]] = False
        each = np.count_nonzero(found, axis=1)
        i = np.repeat(np.arange(len(queries)), each)
        j = np.flatnonzero(found) - i * n
        rough = products(qunit, xunit, i, j)
        least = reached.least
        if not np.isfinite(least).all():  # until the query has k
            table = np.full(found.shape, -2, "f4")
            table[i, j] = rough
            at = max(0, n - k)
            least = np.maximum(least, np.partition(table, at, axis=1)[:, at])
        near = rough >= (least - slack)[i]  # which to rerank
        i, j = i[near], j[near]
        got = best(queries[i], ids[j], cosine(q[i].astype("f8"), x[j].astype("f8")), k)
        reached.add(got[0], got[2])
        return got

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows, each pair by the same sums."""
    def plain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))

    with np.errstate(all="ignore"):
        out = plain(a, b)
        odd = ~np.isfinite(out) | (np.abs(out) > 1 + 1e-9) | ((a * a).sum(1) < 1e-290) | ((b * b).sum(1) < 1e-290)
        if odd.any():  # squares out of range: scaled first
            out[odd] = (unit(a[odd]) * unit(b[odd])).sum(1)
    return out


def nearest(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each row whose id ``every`` divides.

    Nearest is the largest cosine, ties go to the smaller id; a row is no
    neighbour of its own id.  Rows of one id are one row (the smallest vector).
    Vectors that are null, zero, of another dimension than most, or hold null or
    non-finite components take no part, nor do rows without id.
    """
    vectors = stored(one_each(valid_vectors(df, id_col, vector_col).where(F.exists("vector", lambda x: x != 0))), "vectors")
    rows = vectors.count()
    if not rows:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    _, sample = sample_of(vectors, rows)
    d, kind = sample.shape[1], "f4" if isinstance(vectors.schema["vector"].dataType.elementType, FloatType) else "f8"
    rotations = learn_rotations(unit(sample))
    radius = learn_radius(unit(sample), rotations, k) if rows > 1 else BITS

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in slices(batches, max(1, INDEX_VALUES // d)):
            code = codes(unit(x), rotations)
            row = ids.astype("i8").tobytes(), x.astype(kind).tobytes(), code.tobytes(), bucket_rows(code).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([cell], pa.binary()) for cell in row], names=["ids", "vector", "code", "rows"])

    def pack_queries(group: pa.Table) -> pa.Table:
        cells = group.column("id").to_numpy().astype("i8"), matrix(group.column("vector").combine_chunks()).astype(kind)
        return pa.table({name: pa.array([cell.tobytes()], pa.binary()) for name, cell in zip(("qid", "qvector"), cells, strict=True)})

    def search(some: DataFrame, n: int, radius: int) -> DataFrame:
        blocks = max(1, -(-n * d // QUERY_VALUES))
        dealt = some.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        queries = stored(dealt.groupBy("qblock").applyInArrow(pack_queries, "qid binary, qvector binary"), "queries")
        return ranked(searched(met(queries, index, n * d, once=(columns[1:2], columns[3:])), columns, _search(rotations, radius, k, d), "double"), k)

    index = stored(vectors.mapInArrow(pack, "ids binary, vector binary, code binary, rows binary"), "codes")
    columns = ["qid", "qvector", "ids", "vector", "code", "rows"]
    asked = vectors.where(F.col("id") % every == 0)
    found = stored(search(asked, asked.count(), radius), "nearest")

    enough = found.where(F.col("rank") == min(k, max(1, rows - 1))).select(F.col("query_id").alias("id"))
    few = asked.join(enough, "id", "left_anti")
    left = few.count()
    if not left:
        return found
    return found.join(enough, found.query_id == enough.id, "left_semi").unionByName(search(few, left, BITS))
