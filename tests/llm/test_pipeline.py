"""The pipeline against brute-force versions of its stages, each on its own input."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

import corpus_pipeline as P  # noqa: E402
from tallyframe.llm import line_dedup, toxicity  # noqa: E402
from tests.llm.test_line_dedup import brute as brute_lines  # noqa: E402
from tests.llm.test_ngram_join import brute as brute_groups  # noqa: E402
from tests.llm.test_packing import check as check_pieces  # noqa: E402

SF = "/root/testdata/sf0.001"


def given(spark):
    """The table, and with it rows of all odd kinds."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = docs.where("n_chars between 1500 and 4000").orderBy("doc_id").first().text
    odd = [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, text, "en", "s", len(text)), (9003, text, "en", "s", len(text)),
           (9004, text + " one more", "en", "s", 0), (None, "x y z", None, None, None), (None, "x y z", None, None, None)]
    return docs.union(spark.createDataFrame(odd, docs.schema))


def test_stages_equal_brute_force(spark, tmp):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = given(spark)
    columns = docs.columns

    clean = P.drop_toxic(spark, docs, SF).cache()
    model = toxicity.fit(docs, labels)
    rejected = {str(r) for r in docs.collect() if model.scores(toxicity.document_margins(model, pa.array([r.text], pa.string())))[0] >= 0.5}
    assert clean.columns == columns and sorted(map(str, clean.collect())) == sorted(str(r) for r in docs.collect() if str(r) not in rejected)

    lines = P.drop_repeated_lines(spark, clean, SF).cache()
    want = [(i, t) for i, t, n in brute_lines([(r.doc_id, r.text) for r in clean.collect()], line_dedup.MIN_WORDS) if n == 0 or t]
    assert lines.columns == columns and sorted(map(str, ((r.doc_id, r.text) for r in lines.collect()))) == sorted(map(str, want))

    single = P.drop_near_copies(spark, lines, SF).cache()
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    keep, seen = [], set()
    numbered = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    firsts = {i for i, _, c in brute_groups([(n, t) for n, (_, t) in enumerate(numbered)]) if i == c}
    keep = [numbered[i] for i in firsts]
    assert single.columns == columns and sorted(map(str, ((r.doc_id, r.text) for r in single.collect()))) == sorted(map(str, keep))

    texts = {r.doc_id: r.text for r in single.where("doc_id is not null").collect()}
    check_pieces(P.pack_sequences(spark, single.where("doc_id is not null"), SF).collect(), texts, 2048)


def test_run_applies_the_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "packing"] and P.ORACLE_SQL is None
    pieces = P.run(spark, SF)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(pieces.columns)
    assert 0 < pieces.select("doc_id").distinct().count() <= 200


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_columns_of_the_user_come_back_as_they_were(spark):
    names = ["place", "lines_removed", "score", "held_out", "predicted", "doubt", "other", "component_id", "with.dot"]
    docs = given(spark)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs = docs.cache()
    for _, stage in P.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"{i}:{'none' if r.doc_id is None else r.doc_id}" for i in range(len(names))]
