"""Corpus pipeline over ``documents``: toxicity, line dedup, n-gram Jaccard join, packing.

Each stage takes the documents that the one before kept, written as Parquet and
read again, and returns documents (the last: packed pieces).  Columns beside
``USED`` are the user's, whatever their names, and come back as they were.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import line_dedup, ngram_join, packing, toxicity
from tallyframe.llm.common import marked, stored, table, vocabulary


#: Columns that the stages read or change.
USED = ("doc_id", "text", "n_chars")


def untouched(stage):
    """A stage that adds columns of its own leaves columns of the user's by the same names alone: they go by other names meanwhile."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        other = {c: f"__user_{i}" for i, c in enumerate(docs.columns) if c not in USED}
        done = stage(spark, docs.withColumnsRenamed(other), sf_dir)
        kept = done.select(*[other.get(c, c) for c in docs.columns])
        return kept.withColumnsRenamed({v: k for k, v in other.items()})
    return run_stage


@untouched
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the classifier rejects go; it learns from the labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.annotated(docs, model).where("predicted = 0")


@untouched
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later repeated runs of lines go, and documents that were nothing else."""
    kept = line_dedup.dedup_lines(docs).where("lines_removed = 0 or text <> ''")
    length = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", length)


@untouched
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group the document of the smallest id stays (null ids last), once.

    Only documents that are, or by a table of bits may be, copies or repeated rows are joined.
    """
    placed = docs.withColumn("place", F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")))
    groups = stored(ngram_join.ngram_jaccard_join(placed.select("place", "text"), id_col="place"), "groups")
    doubtful = groups.groupBy("place").agg(F.count(F.lit(1)).alias("rows"), F.first(F.col("place") != F.col("component_id")).alias("gone")).where("gone or rows > 1")
    doubtful = stored(doubtful.select(F.col("place").alias("other"), "gone"), "doubtful")
    known = marked(placed, F.col("place"), doubtful, F.col("other"), "doubt")
    firsts = known.where("doubt").join(doubtful.where("gone"), F.col("place") == F.col("other"), "left_anti").dropDuplicates(["place"])
    return known.where("not doubt").unionByName(firsts)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of the remaining documents, with their ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("ngram_jaccard", drop_near_copies), ("packing", pack_sequences)]

#: String kernels, similarity joins and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
