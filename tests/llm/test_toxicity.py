"""Toxicity: kernel against its definition, accuracy on rows that were held out."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import toxicity as T


def plain_model(letters="abcdefghijklmnopqrstuvwxyz"):
    numbers = np.ones(0x3000, "u1")
    numbers[0], numbers[2], numbers[3] = 0, 2, 3
    for n, c in enumerate(letters):
        numbers[ord(c)] = n + 4
    size = len(letters) + 4
    return T.Model(numbers, size, np.zeros(size ** 3, "f4"), 0.0, 1.0)


def subsequences(word):
    marked = f"\x02{word}\x03"
    out = {}
    for i, j, k in itertools.combinations(range(len(marked)), 3):
        if k - i < T.REACH:
            u = marked[i] + marked[j] + marked[k]
            out[u] = out.get(u, 0) + T.DECAY ** (k - i)
    squares = sum(T.DECAY ** (2 * (k - i)) for i, j, k in itertools.combinations(range(len(marked)), 3) if k - i < T.REACH)
    return out, max(squares, T.DECAY ** 4) ** 0.5


def test_kernel_is_that_of_common_subsequences():
    words = ["idiot", "idxiot", "a", "stupid", "abcabc", "worthless"]
    got = T.Explicit(plain_model(), words).kernel(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            (fa, na), (fb, nb) = subsequences(a), subsequences(b)
            assert got[i, j] == pytest.approx(sum(fa[u] * fb.get(u, 0) for u in fa) / (na * nb), rel=1e-5)


def test_folded_weights_score_like_the_kernel():
    model, words = plain_model(), ["idiot", "stupid", "bird"]
    explicit = T.Explicit(model, words)
    alpha = np.array([1.0, 0.5, -2.0])
    model.weights[explicit.found] = alpha @ explicit.landmarks
    tests = ["idiot", "idxiot", "xyz", "stupidly", "bird"]
    assert model.margins(tests) == pytest.approx(explicit.kernel(tests) @ alpha, rel=1e-4, abs=1e-5)


def test_long_words_are_read_to_their_end():
    model = plain_model()
    explicit = T.Explicit(model, ["idiot"])
    model.weights[explicit.found] = explicit.landmarks[0]
    for at in range(0, 60):
        long = "z" * at + "idiot" + "z" * (60 - at)
        assert model.margins([long])[0] > 4 * abs(model.margins(["z" * 65])[0]) + 0.1


def test_letters_are_chosen_by_use_not_by_code_point():
    cyrillic, rare = [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x4E00 + 100)]
    letters = T.alphabet(cyrillic * 3 + ["\U0001F595"] * 2 + rare)
    assert len(letters) == T.MOST_LETTERS and {*cyrillic, "\U0001F595"} <= set(letters)
    model = T.Model(T.numbered(letters), len(letters) + 4, np.zeros((len(letters) + 4) ** 3, "f4"), 0.0, 1.0)
    codes = model.codes(["дурак", "\U0001F595", "\U0001F596"])[0]
    assert len(set(codes[0][1:6].tolist())) == 5
    assert codes[1][1] > 3 and codes[2][1] == 1


def test_spelled_words():
    assert T.spelled_words("you i d i o t there") == ["idiot"]
    assert T.spelled_words("s.t.u.p.i.d") == ["stupid"]
    assert T.spelled_words("a b c and it is") == []
    assert T.spelled_words(None) == []


INSULTS = ["idiot", "moron", "stupid", "scum", "loser"]
SYLLABLES = "the an re on er in ti es ha ou nd at st en to ing ed or ea".split()


def corpus(n, seed=1):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choices(SYLLABLES, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 80))]
        toxic = int(i % 7 == 0)
        for _ in range(2 * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        docs.append((i, " ".join(words), "x", 0.5, 1))
        if i % 2 == 0 or toxic:
            labels.append((i, toxic, 1))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(1200)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double, toxic int").repartition(3)
    lab = spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (3, None, 0)], "doc_id long, toxic int, quality int")
    return d, lab, T.fit(d, lab)


def test_held_out_rows_are_told_apart(spark, fitted):
    d, _, model = fitted
    rows = T.score(d, model).collect()
    assert len(rows) == 1200 and rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 7 == 0) for r in held) >= 0.97 * len(held)


def test_gapped_insults_and_odd_texts(spark, fitted):
    _, _, model = fitted
    bad = ["you idi*ot", "a sttupid thing", "mo-ron", "i d i o t", "IDIOT!!", "x " * 20000 + "scum"]
    good = [None, "", " \n ", "the ing", "x" * 100_000, "the " * 50_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(bad + good + bad)], "doc_id long, text string")
    got = [r.predicted for r in sorted(T.score(df, model).collect(), key=lambda r: r.doc_id)]
    assert got == [1] * len(bad) + [0] * len(good) + [1] * len(bad)


def test_labels_of_the_held_out_fold_change_nothing(spark, fitted):
    d, lab, model = fitted
    from pyspark.sql import functions as F
    turned = lab.withColumn("toxic", F.when(T.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = T.fit(d, turned)
    assert np.array_equal(again.weights, model.weights) and again.threshold == model.threshold


def test_worst_words_are_those_of_the_highest_margins(spark, fitted):
    d, _, model = fitted
    bodies = [r.text for r in d.where("doc_id < 40").collect()] + ["", "i d i o t the", "the the the", "z" * 200 + "moron" + "z" * 200]
    got = T.worst_words(spark.createDataFrame([(b, n % 2) for n, b in enumerate(bodies)], "body string, toxic int"), model)
    want = []
    for n, body in enumerate(bodies):
        words, _, _ = T.words_of(pa.array([body]))
        margins = [*model.margins(words), *(model.margins(T.spelled_words(body)) if T.spelled_words(body) else [])]
        want += [(n % 2, nth, max(float(m), -10.0)) for nth, m in enumerate(sorted(margins, reverse=True)[:T.SHOWN] or [-10.0])]
    assert sorted((t, nth, round(m, 4)) for _, m, t, nth in got) == sorted((t, nth, round(m, 4)) for t, nth, m in want)
    assert all(len(w) <= T._WIDTH for w, *_ in got)


def test_inflected_cyrillic_and_very_long_insults_are_learnt(spark):
    rnd = random.Random(5)
    syllables, long = "на по ко ра то во ли не де му ти ре са ло".split(), "ж" * 70
    docs, labels = [], []
    for i in range(700):
        words = ["".join(rnd.choices(syllables, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 60))]
        if i % 5 == 0:  # a stem with an ending that need not have been seen, or a word of more than 64 letters
            words.insert(rnd.randrange(len(words)), "дурак" + "".join(rnd.choices(syllables, k=2)) if i % 10 else long)
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = T.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = [r for r in T.score(d, model).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in rows) >= 0.97 * len(rows)


def test_copies_of_a_document_are_one_place(spark):
    once = [("the odd glimmerwort here", 1)] * 50 + [(f"re{n} stupid ou{n}", 1) for n in range(30)] + [(f"the an{n} in{n} glim", 0) for n in range(90)]
    found = dict(T.first_insults(spark.createDataFrame(once, "body string, toxic int")))
    assert found.get("stupid") == 30 and "glimmerwort" not in found


@pytest.mark.parametrize("docs,labels", [([], []), ([(1, "a b")], []), ([(1, "a b"), (2, None)], [(1, 1), (2, 0)])])
def test_nothing_to_learn_rejects_nothing(spark, docs, labels):
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = T.score(d, T.fit(d, lab)).collect()
    assert len(rows) == len(docs) and all(r.predicted == 0 and r.score < 1e-6 for r in rows)


def test_documents_margins_are_those_of_single_words(fitted):
    _, _, model = fitted
    texts = ["the idiot and", "the an", "stupidly re", "ha ou"]
    got = T.document_margins(model, pa.array(texts))
    assert got == pytest.approx([max(model.margins(t.split())) for t in texts], abs=1e-5)
