"""Packing against the tokenizer run on whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from tallyframe.llm import packing as P  # noqa: E402
from tallyframe.llm.common import vocabulary  # noqa: E402
from tallyframe.llm.queries import op3_packing  # noqa: E402

VOCAB = "word_bpe_49k.json"
TEXTS = [None, "", " ", "a", "The Cat, it's 12 o'clock!!", "É è ÀÖØ çé, ÿß", "é x", "日本語", "Σας ΣΑΣ İ", "a b  c\x85d", "x\x1cy \x1d",
         "<|endoftext|> a<|startoftext|>b", "don't we'll 'tis", "word " * 5000, "x" * 300, "1234 5", "...!? a.b,c", "ª º µ × ÷", "́ ̸=", "ǅ ŉ ﬁ"]


def odd_texts(n=150):
    rnd = random.Random(4)
    alphabet = ["a", "B", " ", "  ", "é", "É", "\n", "1", ".", ",", "the", "日", "🙂", "\t", "'s", "'", "́", "Σ", " ", "\x1d", "_"]
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(n)]


def library():
    return tokenizers.Tokenizer.from_file(vocabulary(VOCAB))


def check(pieces, texts, length):
    lib, by_doc, by_sequence = library(), defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        want = lib.encode(t or "", add_special_tokens=False).ids + [1]
        got, at = [], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
            assert len(ids) == r.length
            got, at = got + ids, at + r.length
        assert got == want, (i, t)
    fill = {}
    for s, spans in by_sequence.items():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        fill[s] = at
    assert sorted(fill) == list(range(len(fill)))
    assert all(n == length for s, n in fill.items() if s != len(fill) - 1)


@pytest.mark.parametrize("length,parts", [(2048, 3), (7, 5), (1, 1)])
def test_every_id_once_in_full_sequences(spark, length, parts):
    texts = dict(enumerate(TEXTS + odd_texts()))
    df = spark.createDataFrame([(i, t, 9) for i, t in texts.items()], "doc_id long, text string, part int").repartition(parts)
    check(P.pack(df, vocabulary(VOCAB), length).collect(), texts, length)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary(VOCAB)).count() == 0


def test_shuffled_offsets_when_there_are_too_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(P, "MOST_BROADCAST_PARTITIONS", 0)
    texts = dict(enumerate(odd_texts(40)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check(P.pack(df, vocabulary(VOCAB), 16).collect(), texts, 16)


def test_query_checksums(spark, tmp):
    spark.createDataFrame([(1, "The cat sat."), (2, None)], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    got = {r.doc_id: r for r in op3_packing(spark, tmp).collect()}
    for i, t in ((1, "The cat sat."), (2, "")):
        ids = library().encode(t, add_special_tokens=False).ids + [1]
        assert (got[i].length, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
