"""N-gram Jaccard join against all pairs on small tables."""

import random
import re

import numpy as np
import pytest

from tallyframe.llm import ngram_join as J
from tallyframe.llm.graph import components
from tallyframe.llm.shingles import shingle_sets


def brute_sets(texts):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    return out


def brute(rows):
    sets = brute_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids.setdefault(top(i), []).append(d)
    return [(d, len(s), min(ids[top(i)]) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, families=6, copies=25, passage=30):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ü", "THE"]
    common = rnd.choices(vocabulary, k=passage)
    texts = [None, "", "  \n\t ", "one", "ONE", "one two three", "One\ttwo\vthree", "a b c d e", "a b c d e", "a b c d e f", "x " * 50, "x " * 60]
    for _ in range(families):
        base = rnd.choices(vocabulary, k=rnd.randrange(20, 120))
        for _ in range(rnd.randrange(1, copies)):
            words = list(base)
            for _ in range(rnd.randrange(4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [" ".join(rnd.choices(vocabulary, k=rnd.randrange(3, 30)) + common) for _ in range(40)]
    texts += [texts[-1]] * 30 + [" ".join(common)] * 3
    rnd.shuffle(texts)
    return [(7 * i % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,blocks", [(1, None), (2, 3)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, blocks):
    if blocks:  # many blocks in a group
        monkeypatch.setattr(J, "LEAST_SETS", blocks)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, n int, v int").repartition(5)
    got = sorted(map(tuple, J.ngram_jaccard_join(df).collect()))
    assert got == sorted(brute(rows))


def test_null_ids_take_part_and_repeated_rows_stay(spark):
    rows = [(5, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F"), (3, "A B C D E F"), (None, None), (9, "q r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, map(tuple, J.ngram_jaccard_join(df).collect())))
    assert got == sorted(map(str, [(5, 2, 3), (None, 2, 3), (3, 2, 3), (3, 2, 3), (None, 0, None), (9, 1, 9)]))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(4, "only this one text here now")]])
def test_tables_without_links(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.ngram_jaccard_join(df).collect())) == sorted(brute(rows))


def test_set_sizes_are_those_of_the_words():
    texts = [t for _, t in corpus(3)] + ["é É e", "a" * 3000 + " b c d e f", "long " * 400_000]
    assert [len(s) for s in shingle_sets(texts)] == [len(s) for s in brute_sets(texts)]


def test_search_probes_long_lists_exactly():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        pool = np.sort(rnd.choice(2**40, 60, replace=False).astype("u8"))
        sets = [np.sort(rnd.choice(pool, rnd.integers(1, 40), replace=False)) for _ in range(25)]
        sets += [np.sort(rnd.permutation(s)[:max(1, len(s) - rnd.integers(0, 5))]) for s in sets]
        lists = J.Lists(sets)
        for q in sets[::5]:
            want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 80 * len(np.union1d(q, s))]
            assert sorted(lists.partners(q, 80).tolist()) == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 60)}, 3: 3}


@pytest.mark.parametrize("blocks", [None, 3])
def test_every_link_is_counted(spark, monkeypatch, blocks):
    if blocks:  # many blocks in a group
        monkeypatch.setattr(J, "LEAST_SETS", blocks)
    rows = [*corpus(4), (None, "a b c d e f"), (None, "A B C D E F")]
    sets = brute_sets([t for _, t in rows])
    links = [sum(i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets) if b) if a else 0 for i, a in enumerate(sets)]
    assert sum(links) > 2 * len(rows)  # far more than a forest keeps
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(str, map(tuple, J.ngram_jaccard_join(df, with_links=True).collect())))
    assert got == sorted(str((*x, n)) for x, n in zip(brute(rows), links))
