"""Filter audit against documents run through every order one by one."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from tallyframe.llm import filter_audit as A

DDL = "doc_id long, text string, source string, part string, survivors string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(f for f, bad in zip("ABCD", (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        any(c in text for c in "#$%&*|"))) if bad)


def brute(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[i] == 1} for i in (0, 1))
    docs = defaultdict(list)
    for doc, text, source, *_ in rows:
        smaller = any(d is not None and (doc is None or d < doc) and (t or "") == (text or "") for d, t, *_ in rows)
        docs[source or ""].append((doc, fails(text or "") + ("E" if smaller else "")))
    out, shapley = [], Counter()
    for part, held in docs.items():
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                at = [(d, x) for d, x in held if not set(x) & set(order[:k])]
                gone = [d for d, x in at if f in x]
                shapley[part, f] += len(gone)
                out.append([part, order, k + 1, len(at) - len(gone), len(gone), sum(f in x for _, x in held) - len(gone),
                            sum(x == f for _, x in held), sum(d in good for d in gone), sum(d in toxic for d in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def some_rows():
    rnd = random.Random(12)
    names = [f"w{i}" for i in range(200)]
    texts = [None, "", " \t\n\x0b\x0c\r ", "A", "x" * 5, "é" * 19 + "Z", "é" * 18 + "Z", "a\xa0b c", "word " * 20000, " ".join(names), " ".join(names) + "#",
             " ".join(names[:50]), " ".join(names[:49]), "\x0b" + "\x0c".join(names[:50]) + "\r", "A b " * 40, " ".join(names[:65] + names[:35]), " ".join(names[:64] + names[:36])]
    for _ in range(60):
        texts.append(" ".join(rnd.choice([rnd.choice(names), rnd.choice(names).upper(), "|&"]) for _ in range(rnd.randrange(120))))
    rows = [(i, rnd.choice(texts), rnd.choice(["hot", "hot", "cold", None, "", "x y"]), "p", "s") for i in range(150)]
    rows += [(None, texts[9], "hot", "", ""), (None, texts[9], "null", "", ""), (None, None, None, "", ""), (7, rows[7][1], "hot", "", ""), rows[8], rows[8]]
    labels = [(rnd.choice([None, *range(150)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(140)]
    return rows, labels


def test_equals_documents_run_one_by_one(spark):
    rows, labels = some_rows()
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, A.audit(frame, marks).collect())) == brute(rows, labels)


def test_small_flushes_change_nothing(spark, monkeypatch):
    rows, labels = some_rows()
    batch = [(p, q, t, f, n) for p, q, t, f, n in [("a", 0, 1, 3, 5), ("b", 1, 0, 31, 1), ("a", 1, 1, 0, 2 ** 40)]]
    import pyarrow as pa

    def run():
        got = Counter()
        for b in A._survivors(pa.RecordBatch.from_pylist([dict(zip(("part", "quality", "toxic", "fails", "copies"), r))]) for r in batch):
            for part, counts in zip(*(c.to_pylist() for c in b.columns)):
                got.update({(part, i): n for i, n in enumerate(counts)})
        return got
    whole = run()
    monkeypatch.setattr(A, "FLUSH_WORDS", 1)
    monkeypatch.setattr(A, "FLUSH_PARTS", 1)
    assert run() == whole and whole["a", 0] == 5 + 2 ** 40 and whole["a", 3] == 2 ** 40


def test_empty_tables(spark):
    docs, marks = spark.createDataFrame([], DDL), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs, marks).count() == 0
    one = A.audit(spark.createDataFrame([(1, None, None, "", "")], DDL), marks)
    assert one.count() == 600 and one.where("filter_order = 'ABCDE' and step = 1").first().removed == 1


def test_positional_counts_of_any_number_of_words():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 5, 100, 2187, 10000):
        words = rnd.integers(0, 1 << 32, n, "u4")
        assert A.positional_counts(words).tolist() == [int((words >> b & 1).sum()) for b in range(32)]
    copies = rnd.integers(1, 1 << 20, n)
    assert A.weighted_counts(words, copies).tolist() == [int(((words >> b & 1) * copies).sum()) for b in range(32)]
