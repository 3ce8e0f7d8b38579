"""Jaccard self-join of documents on word shingles, as a T-occurrence search.

Two sets of n and m shingles that link share at least T = ceil(0.8 max(n, m)).
Seen over the inverted lists of one set's shingles, its partners are the sets
that occur in at least T of them.  DivideSkip: leave out the T - 1 longest
lists, merge the short rest, and a partner still occurs at least once; only
what the merge finds is probed in the long lists.

1. Every document's set, class key (hash of the whole set, so that copies are
   one class from here on) and size.
2. Shingle frequencies: map tasks send their shingles to buckets, flush by
   flush, one entry per flush and shingle however many sets have it; a bucket
   sends back the frequency of those found in more than one document.
3. Each set puts forward its ``n - T + 1`` rarest shingles, the short lists.
   Lists are merged by bucket, again with one entry per flush and list.  Sets
   that meet in a list, directly or over others, form a candidate group.
4. Groups are cut into blocks of bounded size; every two blocks of a group meet,
   where the search counts short lists and probes long ones by binary search.
   The overlap it ends with is exact; every link is counted at both its ends, a
   forest of the links is kept.
5. Components of the links, and the smallest document id of each.

Buckets know shingles by 32 bits and their own number, which decides candidates
only; overlaps and classes are those of 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import give_back, marked, stored
from tallyframe.llm.graph import components
from tallyframe.llm.shingles import shingle_sets

PERCENT = 80
#: Shingles of one merge task, and shingles a map task gathers before it sends them.
BUCKET_ENTRIES, FLUSH_ENTRIES, SLICE_ROWS = 500_000, 1_500_000, 500
#: A group has BLOCKS blocks, fewer if they would hold less than so many sets, more if they would hold more than so many shingles.
BLOCKS, LEAST_SETS, MOST_SHINGLES = 32, 64, 1_000_000


def needed(n, percent: int = PERCENT):
    """Shingles a set of size n shares at least with any partner."""
    return -(-percent * n // 100)


def class_key(shingles: np.ndarray) -> int:
    """Signed 64-bit key of a whole set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sizes_and_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                some = batch.slice(lo, SLICE_ROWS)
                sets = list(shingle_sets(some.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([class_key(s) if len(s) else None for s in sets], pa.int64())], names=[id_col, "n", "v"])
        give_back()

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n long, v long")


def _linked_runs(key: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists given as (key, v) pairs: each list's first v, and (first, other) edges."""
    order = np.lexsort((v, key))
    key, v = key[order], v[order]
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
    first = v[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(key) else v
    apart = first != v
    return key[new], v[new], first[apart], v[apart]


def _edges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.empty((0, 2), "i8")


def _steps(keys: np.ndarray) -> bytes:
    """Ascending keys as differences of their lower 32 bits, which compress well."""
    return np.diff(keys.astype("u4"), prepend=np.uint32(0)).astype("<u4").tobytes()


def _unsteps(data: bytes | None) -> np.ndarray:
    return np.cumsum(np.frombuffer(data or b"", "<u4"), dtype="u4")


def _cut(keys: np.ndarray, buckets: np.ndarray) -> list[tuple[int, int]]:
    """``from, to`` of some ascending buckets in ascending keys, whose bits above 32 are the bucket."""
    high = keys >> np.uint64(32)
    return list(zip(np.searchsorted(high, buckets, "left").tolist(), np.searchsorted(high, buckets, "right").tolist()))


def _sent_shingles(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """Every task's shingles by bucket, a flush of about FLUSH_ENTRIES at a time.

    A shingle that one set of the flush has goes with the set's number; one that
    several have goes once, with their count, and who has it stays with the
    flush (``lkey, lowner``, with the sets' keys ``v`` and sizes ``n``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, flushes, size = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        classes: list[int] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(s) for s in held])
            key = np.concatenate(held) >> np.uint64(32 - bits)
            order = np.argsort(key, kind="stable")
            key, owner = key[order], np.repeat(np.arange(len(held), dtype="u2"), sizes)[order]
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            times = np.diff(np.append(new, len(key)))
            once, often = new[times == 1], new[times > 1]
            shared = np.repeat(times > 1, times)
            number = part << 32 | flushes
            buckets = np.unique(key >> np.uint64(32))  # those the flush has, of all that there are
            rows = [{"bucket": b, "flush": number, "once": _steps(key[once[i:j]]), "owner": owner[once[i:j]].tobytes(),
                     "often": _steps(key[often[k:m]]), "times": times[times > 1][k:m].astype("<u4").tobytes()}
                    for b, (i, j), (k, m) in zip(buckets.tolist(), _cut(key[once], buckets), _cut(key[often], buckets))]
            rows.append({"bucket": number % (1 << bits), "flush": number, "lkey": key[shared].tobytes(), "lowner": owner[shared].tobytes(),
                         "v": np.array(classes, "i8").tobytes(), "n": sizes.astype("i8").tobytes()})
            return pa.RecordBatch.from_pylist(rows, _SENT)

        for texts in (b.column(0).slice(lo, SLICE_ROWS).to_pylist() for b in batches for lo in range(0, b.num_rows, SLICE_ROWS)):
            for one in shingle_sets(texts):
                if not len(one) or (v := class_key(one)) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(v)
                held.append(one)
                classes.append(v)
                size += len(one)
                if size > FLUSH_ENTRIES or len(held) == 65_535:
                    yield flush()
                    held, classes, size, flushes = [], [], 0, flushes + 1
        if held:
            yield flush()
        held, seen = [], set()
        give_back()

    return docs.select(text_col).mapInArrow(run, "bucket int, flush long, once binary, owner binary, often binary, times binary, lkey binary, lowner binary, v binary, n binary")


_SENT = pa.schema([("bucket", pa.int32()), ("flush", pa.int64()), *((c, pa.binary()) for c in ("once", "owner", "often", "times", "lkey", "lowner", "v", "n"))])
_KNOWN = pa.schema([("flush", pa.int64()), *((c, pa.binary()) for c in ("key", "owner", "df", "okey", "odf", "lkey", "lowner", "v", "n"))])
_SHORT = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("shingles", "firsts", "pairs"))])


def _counted(group: pa.Table) -> pa.Table:
    """A bucket's shingles with their document frequency, back to each flush; those of one document are left out."""
    rows = group.to_pylist()
    once, often = [_unsteps(r["once"]) for r in rows], [_unsteps(r["often"]) for r in rows]
    times = [np.frombuffer(r["times"] or b"", "<u4") for r in rows]
    _, which = np.unique(np.concatenate(once + often), return_inverse=True)
    df = np.bincount(which, np.concatenate([*(np.ones(len(o)) for o in once), *times])).astype("u4")[which] if len(which) else np.empty(0, "u4")
    df = np.split(df, np.cumsum([len(x) for x in once + often])[:-1])
    out = []
    for row, a, b, da, db in zip(rows, once, often, df, df[len(rows):]):
        high, met = np.uint64(row["bucket"] << 32), da > 1
        out.append({"flush": row["flush"], "key": (high | a[met]).tobytes(), "owner": np.frombuffer(row["owner"] or b"", "u2")[met].tobytes(), "df": da[met].tobytes(),
                    "okey": (high | b).tobytes(), "odf": db.tobytes(), **{c: row[c] for c in ("lkey", "lowner", "v", "n")}})
    return pa.Table.from_pylist(out, _KNOWN)


def _short_lists(percent: int):
    """For a flush: the shared shingles among each set's rarest ``n - T + 1``, as list entries by bucket."""

    def run(group: pa.Table) -> pa.Table:
        def flat(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(x or b"" for x in group.column(name).to_pylist()), kind)

        okey, odf, lkey, v, n = flat("okey", "u8"), flat("odf", "u4"), flat("lkey", "u8"), flat("v", "i8"), flat("n", "i8")
        by_key = np.argsort(okey)
        local_df = odf[by_key][np.searchsorted(okey[by_key], lkey)]
        key, owner, df = np.concatenate([flat("key", "u8"), lkey]), np.concatenate([flat("owner", "u2"), flat("lowner", "u2")]).astype(int), np.concatenate([flat("df", "u4"), local_df])
        order = np.lexsort((key, df, owner))
        key, owner = key[order], owner[order]
        met = np.bincount(owner, minlength=len(n))
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(met) - met, met)
        alone = n - met  # shingles of this document only come first and meet nobody
        taken = nth < (n - needed(n, percent) + 1 - alone)[owner]
        shingle, first, a, b = _linked_runs(key[taken], v[owner[taken]])
        pairs = _edges(a, b)
        buckets = np.unique(shingle >> np.uint64(32))
        share = np.linspace(0, len(pairs), len(buckets) + 1).astype(int)  # found edges travel with any bucket that there is
        return pa.Table.from_pylist([
            {"bucket": b, "shingles": shingle[lo:hi].tobytes(), "firsts": first[lo:hi].tobytes(), "pairs": pairs[share[i]:share[i + 1]].tobytes()}
            for i, (b, (lo, hi)) in enumerate(zip(buckets.tolist(), _cut(shingle, buckets)))], _SHORT)

    return run


def _merged_lists(group: pa.Table) -> pa.Table:
    shingle, first, old = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in (("shingles", "u8"), ("firsts", "i8"), ("pairs", "i8")))
    _, _, a, b = _linked_runs(shingle, first)
    pairs = _edges(np.concatenate([a, old[::2]]), np.concatenate([b, old[1::2]]))
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _candidate_edges(docs: DataFrame, text_col: str, bits: int, percent: int) -> DataFrame:
    """Edges ``a, b`` between class keys that meet in short lists."""
    counted = _sent_shingles(docs, text_col, bits).groupBy("bucket").applyInArrow(
        _counted, "flush long, key binary, owner binary, df binary, okey binary, odf binary, lkey binary, lowner binary, v binary, n binary")
    short = counted.groupBy("flush").applyInArrow(_short_lists(percent), "bucket int, shingles binary, firsts binary, pairs binary")
    return short.groupBy("bucket").applyInArrow(_merged_lists, "a long, b long").distinct()


class Lists:
    """Inverted lists of some sets: entries sorted by shingle, then by set."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        flat = np.concatenate(sets)
        order = np.lexsort((owner, flat))
        self.shingle, self.owner = flat[order], owner[order]

    def partners(self, query: np.ndarray, percent: int, after: int = -1) -> np.ndarray:
        """Sets behind number ``after`` that link with the query."""
        lo, hi = np.searchsorted(self.shingle, query, "left"), np.searchsorted(self.shingle, query, "right")
        hit = hi > lo
        lo, hi = lo[hit], hi[hit]
        least = needed(len(query), percent)
        if len(lo) < least:
            return np.empty(0, int)
        order = np.argsort(hi - lo, kind="stable")
        lo, hi = lo[order], hi[order]
        short = len(lo) - least + 1  # the rest are the least - 1 longest lists
        n = hi[:short] - lo[:short]
        at = np.repeat(lo[:short] - np.cumsum(n) + n, n) + np.arange(n.sum())
        count = np.bincount(self.owner[at], minlength=len(self.sizes))
        found = np.flatnonzero(count)
        found = found[(found > after) & (100 * np.minimum(self.sizes[found], len(query)) >= percent * np.maximum(self.sizes[found], len(query)))]
        count, left = count[found], len(lo) - short
        for a, b in zip(lo[short:].tolist(), hi[short:].tolist()):
            can = 100 * (count + left) >= percent * (self.sizes[found] + len(query) - count - left)
            if not can.all():
                found, count = found[can], count[can]
            if not len(found):
                return found
            in_list = self.owner[a:b]  # a long list: binary probes of what is still possible
            count = count + (in_list[np.minimum(np.searchsorted(in_list, found), b - a - 1)] == found)
            left -= 1
        return found[100 * count >= percent * (self.sizes[found] + len(query) - count)]


def _forest(index: list[np.ndarray], queries: list[np.ndarray] | None, percent: int, copies: np.ndarray, others: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Links as a forest: (number in index, number in queries); of the index with itself if there are no queries.

    Also the documents that each set of the index, and each query, links with
    here, by how many documents have a set (``copies``, of queries ``others``).
    """
    lists = Lists(index)
    root = list(range(len(index) + len(queries or ())))
    of_index = np.zeros(len(index), "i8")
    of_queries = of_index if queries is None else np.zeros(len(queries), "i8")
    weights = copies if queries is None else others

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for q, query in enumerate(index if queries is None else queries):
        node = q if queries is None else len(index) + q
        found = lists.partners(query, percent, q if queries is None else -1)
        of_index[found] += weights[q]
        of_queries[q] += copies[found].sum()
        for other in found.tolist():
            a, b = top(other), top(node)
            if a != b:
                root[a] = b
                out.append((other, q))
    return out, of_index, of_queries


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Forest edges ``a, b`` of the links within groups, and ``a, links``: parts of the number of documents a set links with.

    Every two blocks of a group meet once.
    """

    def block(group: pa.Table) -> pa.Table:
        found = dict(zip(group.column("v").to_pylist(), group.column("shingles").to_pylist()))
        copies = dict(zip(group.column("v").to_pylist(), group.column("copies").to_pylist()))
        return pa.table({
            "label": group.column("label").slice(0, 1), "block": group.column("block").slice(0, 1), "blocks": group.column("blocks").slice(0, 1),
            "v": pa.array([np.array(list(found), "i8").tobytes()], pa.binary()),
            "copies": pa.array([np.array([copies[v] for v in found], "i8").tobytes()], pa.binary()),
            "n": pa.array([np.array([len(s) // 8 for s in found.values()], "i8").tobytes()], pa.binary()),
            "shingles": pa.array([b"".join(found.values())], pa.binary())})

    def unpack(v: bytes, copies: bytes, n: bytes, shingles: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        return np.frombuffer(v, "i8"), np.frombuffer(copies, "i8"), np.split(np.frombuffer(shingles, "u8"), np.cumsum(np.frombuffer(n, "i8"))[:-1])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, counts = [], []
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(batch.num_columns)]
                v, copies, index = unpack(*row[:4])
                w, others, queries = unpack(*row[4:]) if len(row) > 4 else (v, None, None)
                links, of_index, of_queries = _forest(index, queries, percent, copies, others)
                for key, count in ((v, of_index), (w, of_queries))[:1 if queries is None else 2]:
                    ends.append(key[count > 0])
                    counts.append(count[count > 0])
                yield pa.RecordBatch.from_arrays([pa.array([v[a] for a, _ in links], pa.int64()), pa.array([w[b] for _, b in links], pa.int64()), pa.nulls(len(links), pa.int64())], names=["a", "b", "links"])
            if ends:  # a set that meets several blocks here is one row
                keys, at = np.unique(np.concatenate(ends), return_inverse=True)
                total = np.zeros(len(keys), "i8")
                np.add.at(total, at, np.concatenate(counts))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.nulls(len(keys), pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "links"])
        give_back()

    shape = "label long, block int, blocks int, v binary, copies binary, n binary, shingles binary"
    blocks = stored(sets.groupBy("label", "block").applyInArrow(block, shape), "blocks")
    within = blocks.select("v", "copies", "n", "shingles").mapInArrow(search, "a long, b long, links long")
    left = blocks.where("block + 1 < blocks").withColumn("other", F.explode(F.expr("sequence(block + 1, blocks - 1)"))).select(
        F.col("label").alias("l"), "other", "v", "copies", "n", "shingles")
    right = blocks.where("block > 0").select("label", "block", *(F.col(c).alias(f"{c}2") for c in ("v", "copies", "n", "shingles")))
    across = left.join(right, (F.col("l") == F.col("label")) & (F.col("other") == F.col("block"))).select(
        "v", "copies", "n", "shingles", "v2", "copies2", "n2", "shingles2").mapInArrow(search, "a long, b long, links long")
    return within.union(across)


def ngram_jaccard_join(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", with_links: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, and ``n_links`` if asked for.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set is
    the distinct shingles of 5 words, the whole sequence if there are fewer,
    empty for a null text or one without words.  Two sets link when
    ``100 |A and B| >= percent |A or B|``; the component is the smallest id
    reachable over links.  An empty set links with nothing, so its component is
    its own id.  ``n_links`` is the number of other rows that a row links with,
    copies among them.  Repeated rows come back as often as they stand there; null ids
    take part and are never the smallest.
    """
    narrow = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    sizes = stored(_sizes_and_keys(narrow, "doc", "body"), "sizes")
    classes = sizes.where("n > 0").groupBy("v").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    entries = sizes.agg(F.sum("n")).first()[0] or 0
    bits = max(4, (entries // BUCKET_ENTRIES).bit_length())
    groups = components(_candidate_edges(narrow, "body", bits, percent))
    members = groups.join(classes, "v")
    weights = members.groupBy("label").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("weight")).select(
        F.col("label").alias("of"), F.greatest(F.least(F.lit(BLOCKS), F.ceil(F.col("sets") / LEAST_SETS)), F.ceil(F.col("weight") / MOST_SHINGLES)).cast("int").alias("blocks"))
    members = stored(members.join(weights, F.col("label") == F.col("of")).select(
        "v", "copies", F.col("doc").alias("member"), "label", "blocks", F.expr("cast(pmod(xxhash64(v), blocks) as int)").alias("block")), "members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (b.slice(lo, SLICE_ROWS) for b in batches for lo in range(0, b.num_rows, SLICE_ROWS)):
            found = list(shingle_sets(some.column(0).to_pylist()))
            keep = pa.array([bool(len(s)) and class_key(s) == v for s, v in zip(found, some.column(1).to_pylist())], pa.bool_())
            full = pa.RecordBatch.from_arrays([*some.columns[1:], pa.array([s.tobytes() for s in found], pa.binary())], names=["v", "copies", "label", "block", "blocks", "shingles"])
            yield full.filter(keep)
        give_back()

    near = marked(narrow, F.col("doc"), members, F.col("member"), "__near").where("__near").drop("__near")  # other texts are not shuffled
    texts = near.join(members.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("member"))).select("body", "v", "copies", "label", "block", "blocks")
    links = stored(_links(texts.mapInArrow(sets, "v long, copies long, label long, block int, blocks int, shingles binary"), percent), "links")
    linked = components(links.where("b is not null").select("a", "b")).withColumnRenamed("v", "linked_v")
    if with_links:
        none = F.lit(None).cast("long").alias("label")
        counts = links.where("b is null").select("a", none, "links").union(classes.where("copies > 1").select("v", none, F.col("copies") - 1))
        linked = linked.select("linked_v", "label", F.lit(0).cast("long").alias("links")).union(counts).groupBy("linked_v").agg(F.max("label").alias("label"), F.sum("links").alias("links"))
    more = [F.coalesce("links", F.lit(0)).cast("long").alias("links")] if with_links else []
    named = sizes.join(linked, sizes.v == linked.linked_v, "left").select(
        "doc", "n", F.when(F.col("n") > 0, F.coalesce("label", "v")).alias("c"), *more)
    smallest = named.where("n > 0").groupBy("c").agg(F.min("doc").alias("least")).withColumnRenamed("c", "of")
    return named.join(smallest, named.c == smallest.of, "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"),
        *([F.col("links").alias("n_links")] if with_links else []))
