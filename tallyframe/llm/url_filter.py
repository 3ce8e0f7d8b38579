"""URL filtering by rules held in Bloom filter cascades.

The keys of a URL are its host and parent domains, each with the beginnings of
its path that are as long as some rule's.  All distinct keys of the corpus are
the key universe.  A cascade holds a list of keys: its first filter encodes the
listed keys, the second those keys of the universe that the first takes wrongly,
the third the listed keys that the second takes wrongly, and so on until none
is left; a key is listed when the first filter that refuses it is an even one.
Over its universe the answer is exact, and looking it up needs no join.

The first filter's error rate is the number of listed keys over that of the
universe, so all later levels are about as large as the list: what goes to the
tasks is bounded by the rules (``MOST_RULES``), not by the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
#: Rules are a parameter and travel to every task.
MOST_RULES = 1_000_000


class Filter:
    """A Bloom filter of keys; ``seed`` makes the hashes of levels independent."""

    def __init__(self, keys: Iterable[str], rate: float, seed: int):
        keys = list(keys)
        self.seed, self.hashes = seed, max(1, math.ceil(math.log2(1 / rate)))
        self.size = max(8, math.ceil(len(keys) * self.hashes / math.log(2)))
        self.bits = bytearray(self.size // 8 + 1)
        for key in keys:
            for at in self._places(key):
                self.bits[at >> 3] |= 1 << (at & 7)

    def _places(self, key: str) -> Iterator[int]:
        import xxhash

        whole = xxhash.xxh3_128_intdigest(key.encode(), self.seed)
        first, step = whole >> 64, whole & (1 << 64) - 1 | 1
        return ((first + i * step) % self.size for i in range(self.hashes))

    def __contains__(self, key: str) -> bool:
        return all(self.bits[at >> 3] >> (at & 7) & 1 for at in self._places(key))


class Cascade:
    """Exact membership in a list for all keys of a universe."""

    def __init__(self, levels: list[Filter]):
        self.levels = levels

    def __contains__(self, key: str) -> bool:
        for n, level in enumerate(self.levels):
            if key not in level:
                return n % 2 == 1
        return len(self.levels) % 2 == 1

    @classmethod
    def over(cls, listed: set[str], universe: DataFrame, size: int, seed: int) -> Cascade:
        """``universe`` is a table of one column of distinct keys, ``size`` its rows."""
        if not listed:
            return cls([])
        rate = min(0.5, len(listed) / (math.sqrt(2) * max(1, size)))
        first = Filter(listed, rate, seed)

        def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                taken = [k for k in batch.column(0).to_pylist() if k in first and k not in listed]
                yield pa.RecordBatch.from_arrays([pa.array(taken, pa.string())], names=["key"])

        wrongly = universe.mapInArrow(wrong, "key string")
        others = {r.key for r in wrongly.limit(4 * len(listed) + 64).collect()}
        if len(others) > 3 * len(listed) + 48:  # an unlucky filter: other hashes
            return cls.over(listed, universe, size, seed + 1000)
        levels, held, tested = [first], others, listed
        while held:
            levels.append(Filter(held, 0.5, seed + len(levels)))
            held, tested = {k for k in tested if k in levels[-1]}, held
        return cls(levels)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def keys_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """A URL's keys in the shapes of the rules, longest first (of equal ones the longer host)."""
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in rules})
    labels = F.split(host, r"\.")
    one = [F.when((F.size(labels) >= n) & (F.length(path) >= k) & (host != ""),
                  F.struct((-F.length(domain) - k).alias("order"), F.lit(k).alias("path_length"), F.concat(domain, F.substring(path, 1, k)).alias("key")))
           for n, k in shapes for domain in [F.array_join(F.slice(labels, -n, n), ".")]]
    if not one:
        return F.array().cast("array<string>")
    return F.transform(F.array_sort(F.array_compact(F.array(*one))), lambda x: x["key"])


def filter_urls(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """One row per input row: ``id_col, host, path, rule, verdict``.

    ``rules`` maps ``host/path`` to block or allow.  A rule fits its host and all
    subdomains when the URL's path starts with the rule's; the longest rule that
    fits decides (of two equally long, the one with the longer host).  Where no
    rule fits, ``rule`` is null and the key set holds nothing against the URL:
    ``default``.  A null URL, or one without ``://``, has an empty host and path
    and no keys.  Repeated rows are judged alike; other columns are not read.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    split = {r: (r[:r.index("/")], r[r.index("/"):]) for r in rules}
    host, path = host_and_path(F.col(url_col))
    keyed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    keyed = keyed.withColumn("keys", keys_of(F.col("host"), F.col("path"), split.values()))
    universe = keyed.select(F.explode("keys").alias("key")).distinct()
    size = universe.count()
    cascades = [(v, Cascade.over({r for r, x in rules.items() if x == v}, universe, size, seed)) for seed, v in enumerate((BLOCK, ALLOW))]
    id_type = pages.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for keys in batch.column(3).to_pylist():
                found.append(next(((k, v) for k in keys for v, cascade in cascades if k in cascade), (None, default)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return keyed.mapInArrow(judge, f"`{id_col}` {id_type}, host string, path string, rule string, verdict string")
