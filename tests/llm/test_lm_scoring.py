"""Language-model scores against the same model counted and fitted one token at a time."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import lm_scoring as M
from tallyframe.llm import word_slices as W

DDL = "doc_id long, text string, part int, ids string, score string"
END = None


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), END]


def brute(rows):
    single, double = defaultdict(Counter), defaultdict(Counter)
    docs = [(i, tokens(t), p or 0) for i, t, p, *_ in rows]
    for _, words, part in docs:
        single[part].update(words)
        double[part].update(zip([END, *words], words))

    def shares(c1, c2, a, b):
        return (c2[a, b] / c1[a] if c1[a] else 0, c1[b] / max(1, sum(c1.values())), 1 / (len(c1) + 1))

    weights = {b: [0, .5, .5] if b == 0 else [1 / 3] * 3 for b in range(M.BUCKETS)}
    for _ in range(M.ROUNDS):
        sums = {b: [0 if b == 0 else 1, 1, 1] for b in weights}
        for (a, b), n in double[1].items():
            k = single[0][a].bit_length()
            f = [w * x for w, x in zip(weights[k], shares(single[0], double[0], a, b))]
            sums[k] = [s + n * x / sum(f) for s, x in zip(sums[k], f)]
        new = {b: [x / sum(s) for x in s] for b, s in sums.items()}
        moved = max(abs(x - y) for b in new for x, y in zip(new[b], weights[b]))
        weights = new
        if moved < M.STILL:
            break
    c1, c2 = single[0] + single[1], double[0] + double[1]
    n, v = sum(c1.values()), len(c1)
    out = []
    for i, words, part in docs:
        base = sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in words)
        score = sum(math.log10(sum(x * y for x, y in zip(weights[c1[a].bit_length()], shares(c1, c2, a, b)))) for a, b in zip([END, *words], words))
        out.append((i, part == 2, len(words), sum(c1[w] > 0 for w in words), n, pytest.approx(base), pytest.approx(score)))
    return out


def some_rows():
    rnd = random.Random(13)
    words = [f"w{i}" for i in range(40)]
    texts = [None, "", " \n\t", "A a\x0bA", "É é\xa0é", "unseen", "w1 w2 w3 " * 3000]
    for _ in range(120):
        at, text = rnd.randrange(40), []
        for _ in range(rnd.randrange(30)):
            at = (at + rnd.choice([1, 1, 1, 2, 7])) % 40
            text.append(rnd.choice([words[at], words[at].upper()]))
        texts.append(rnd.choice([" ", "\n", "  "]).join(text))
    rows = [(i, t, rnd.choice([0, 0, 0, 1, 2, None]), "x", "y") for i, t in enumerate(texts)]
    return [r for r in rows if r[1] != "unseen"] + [(500, "unseen w1", 2, "", ""), rows[10], rows[10], (None, "w1 w2", 1, "", "")]


def key(r):
    return str(r[:5])


def test_equals_the_model_token_by_token(spark):
    rows = some_rows()
    got = M.lm_scores(spark.createDataFrame(rows, DDL).repartition(3), F.col("part"))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_slices_and_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "STRETCH", 7)
    for name, value in (("SLICE_BYTES", 2000), ("CHUNK_BYTES", 700), ("BUCKET_WORDS", 500)):
        monkeypatch.setattr(W, name, value)
    rows = some_rows()
    got = M.lm_scores(spark.createDataFrame(rows, DDL).repartition(4), F.col("part"))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_without_training_weights_or_rows(spark):
    assert M.lm_scores(spark.createDataFrame([], DDL), F.col("part")).count() == 0
    for part in (0, 1, 2):
        rows = [(1, "a b a", part, "", ""), (2, None, part, "", "")]
        got = M.lm_scores(spark.createDataFrame(rows, DDL), F.col("part"))
        assert sorted(map(tuple, got.collect())) == brute(rows)
