"""Collocations against every phrase counted one by one."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import collocations as C
from tallyframe.llm import word_slices as W

DDL = "doc_id long, text string, lang string, word string, id long"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, most, first):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i:i + m])) for m in range(1, most + 1) for i in range(len(words) - m + 1))
    often = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    inside = {(lang, g[i:j]) for (lang, g), n in often.items() for i in range(len(g)) for j in range(i + 1, len(g) + 1) if j - i < len(g) and counts[lang, g[i:j]] <= n}
    out = []
    for lang in totals:
        best = []
        for (x, g), a in often.items():
            if x == lang and (x, g) not in inside:
                score, k = min((floor(Fraction(1000 * a * totals[lang], counts[lang, g[:k]] * counts[lang, g[k:]])), k) for k in range(1, len(g)))
                best.append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:first])]
    return sorted(out)


def some_rows():
    rnd = random.Random(11)
    words = ["a", "b", "The", "é", "É", "x\xa0y", "z#", "\x0bq", "ab"]
    texts = ["a a a a a a. a a a", "", None, " . ,;:!? \n", "a b\ta  b\x0ca b", "one two three four five six " * 30, "The é the É THE é"]
    for _ in range(80):
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(rnd.randrange(60))))
    rows = [(i, t, rnd.choice(["en", "en", "de", None, "und", ""]), "w", i) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, texts[5], None, None, None)]


@pytest.mark.parametrize("least,most,first", [(3, 5, 2000), (2, 3, 4), (10 ** 6, 5, 5)])
def test_equals_phrases_counted_one_by_one(spark, least, most, first):
    rows = some_rows()
    frame = spark.createDataFrame(rows, DDL).repartition(4)
    got = sorted(map(tuple, C.collocations(frame, least, most, first).collect()))
    assert got == brute(rows, least, most, first) and (got or least > 1000)


def test_slices_tiles_and_buckets_change_nothing(spark, monkeypatch):
    rows = some_rows()
    for name, value in (("SLICE_BYTES", 300), ("CHUNK_BYTES", 100), ("BUCKET_WORDS", 50)):
        monkeypatch.setattr(W, name, value)
    monkeypatch.setattr(C, "TILE_BITS", 1)
    monkeypatch.setattr(C, "CORNER", 2)
    got = sorted(map(tuple, C.collocations(spark.createDataFrame(rows, DDL).repartition(3), 3, 5, 50).collect()))
    assert got == brute(rows, 3, 5, 50)


def test_empty_table_and_one_long_text(spark):
    assert C.collocations(spark.createDataFrame([], DDL)).count() == 0
    long = [(1, "p q r s t u. " * 20000 + "p q", "en", "", 0)]
    assert sorted(map(tuple, C.collocations(spark.createDataFrame(long, DDL)).collect())) == brute(long, 100, 5, 2000)


def test_products_beyond_64_bits_are_exact(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(40):
        n = 10 ** rnd.randrange(9, 14)
        heads = sorted((rnd.randrange(100, 10 ** 9) for _ in range(4)), reverse=True)
        tails = sorted((rnd.randrange(100, heads[-1]) if k else heads[-1] for k in range(4)), reverse=True)
        rows.append((i, heads, [*tails[:3], heads[-1]], heads[-1], n))
    frame = spark.createDataFrame(rows, "i int, heads array<long>, tails array<long>, n long, total long")
    for r in frame.select("*", C.lowest_cut(F.col("heads"), F.col("tails"), F.col("n"), F.col("total")).alias("cut")).collect():
        score, k = min((1000 * r.n * r.total // (r.heads[k - 1] * r.tails[len(r.heads) - k - 1]), k) for k in range(1, 4))
        assert (r.cut.score, r.cut.k) == (score, k)


def test_dense_and_sparse_tiles_count_alike():
    rnd = np.random.default_rng(1)
    line = np.where(rnd.random(400_000) < .8, np.minimum(rnd.zipf(1.3, 400_000), 40_000), 0).astype("u4")
    keys, n = C.count_pairs(line)
    want, m = np.unique(C._pairs(line), return_counts=True)
    assert (keys == want).all() and (n == m).all()
    assert [x.tolist() for x in C.count_pairs(line[:0])] == [[], []]


def test_packed_numbers():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 7, 10000):
        keys = np.sort(rnd.integers(0, 1 << 63, n, "u8"))
        assert (W.unpacked_sorted(W.packed_sorted(keys)) == keys).all()
        assert (W.unpacked(W.packed(keys.astype("u4")), "u4") == keys.astype("u4")).all()
