"""The corpus pipeline: documents are judged, near-duplicates and repeated passages go, benchmark leaks go, the rest is tokenized.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the last return the columns
of ``documents``. Every stage keeps null and empty texts, unless its operator rejects them, and works on empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import byte_bpe, decontaminate, jaccard_join, quality_rank, suffix_dedup
from ledgerlight.llm.common import checkpointed, private
from ledgerlight.llm.queries import bpe_vocabulary, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below the cut go."""
    ranker = quality_rank.fit_ranker(docs, table(spark, sf_dir, "labels"))
    names = private("score"), private("predicted")
    return quality_rank.score(docs, ranker, keep=True, names=names).where(F.col(names[1]) == 1).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that repeat an earlier string of 100 bytes are cut out; what is left of a character that was cut goes too.

    Rows from which nothing is cut stay as they are.
    """
    mark = private("cut")
    cut = suffix_dedup.remove_repeats(docs.withColumn(f"{mark}null", F.col("text").isNull()), rest=True, prefix=mark, characters=True)
    text = F.when(~F.col(f"{mark}null"), F.col(f"{mark}kept").cast("string"))
    n_chars = F.when(F.col(f"{mark}n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("text", text).withColumn("n_chars", n_chars).select(*docs.columns)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or one within the allowed edits, go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, their number, and whether they decode to its text."""
    vocabulary = bpe_vocabulary(spark)
    back = byte_bpe.encode(docs, vocabulary, decoded="decoded")
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", same.alias("decodes"))


STAGES = [
    ("quality_classifier", keep_good),
    ("jaccard_join", keep_one_of_each),
    ("suffix_dedup", remove_repeated_passages),
    ("decontamination", remove_leaks),
    ("byte_bpe", tokenize),
]

#: The stages can't be expressed in SQL; tests/llm/test_pipeline.py holds each against a direct version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
