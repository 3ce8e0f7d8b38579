"""SentencePiece operator against the library run on whole texts."""

import hashlib
import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")

from tallyframe.llm import sentence_codec as S  # noqa: E402
from tallyframe.llm.common import vocabulary  # noqa: E402
from tallyframe.llm.queries import op1_sentencepiece  # noqa: E402

MODEL = "piece_bpe_32k.model"
TEXTS = [None, "", " ", "   ", "a", " a", "a ", "a  b", "\n\n x \t y", "▁ a", "a▁ b", "b▁▁ c", "<s> </s>", "naïve ﬁ é", "日本語 テキスト",
         "🙂🙂 x\u0000y", "  x y", "é x", "word " * 3000, "x" * 5000, "Σας ΣΑΣ İ", "\r\n\x1c\x85"]


def odd_texts(n=120):
    rnd = random.Random(3)
    alphabet = ["a", "B", " ", "  ", "é", "▁", "\n", "1", ".", "the", "日", "🙂", "\t", "'s"]
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(n)]


def test_chunks_rebuild_the_text():
    for t in TEXTS[1:] + odd_texts():
        assert " ".join(S.chunks(t)) == t or t == ""


def test_ids_and_text_equal_the_library(spark):
    texts = TEXTS + odd_texts() + TEXTS
    rows = [(i if i != 5 else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = S.encode_decode(df, vocabulary(MODEL)).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary(MODEL))
    want = sorted((str(i), lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for i, t, _ in rows)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == want


def test_pieces_across_markers_are_noticed():
    class Model:
        def get_piece_size(self):
            return 2

        def id_to_piece(self, i):
            return ["▁▁a", "of▁the"][i]

    assert not S.markers_bound_pieces(Model())


def test_empty_table(spark):
    assert S.encode_decode(spark.createDataFrame([], "doc_id long, text string"), vocabulary(MODEL)).count() == 0


def test_query_digests(spark, tmp):
    rows = [(1, "The cat  sat."), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary(MODEL))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in op1_sentencepiece(spark, tmp).collect()}
    for i, t in rows:
        ids = lib.encode(t or "")
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids) if ids else ""))
