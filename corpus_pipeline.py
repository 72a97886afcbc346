"""From raw documents to a training mix: five stages, each on all that the one before kept.

Every stage takes null values in any column, empty and very long texts, repeated rows (each a document of its own),
empty tables and further columns, which it leaves out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewarden.llm import decontamination, linededup, mixing, neardup, quality
from scorewarden.llm.queries import learnable, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The last stage's choice by words, the classifier and the pruned join are beyond SQL; tests hold each against brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from this stage's own input.

    Null and empty texts are scored like any other; without labelled rows every score is 0.5 and no document is kept.
    """
    weights = quality.fit(docs, learnable(table(spark, sf_dir, "labels")))
    return quality.score(docs.select(*COLUMNS), weights, name="_score").where("_score >= 0.7").select(*COLUMNS)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; n_chars follows the text.

    A null text is one empty line and comes out as an empty text. No document is left out.
    """
    kept = linededup.drop_frequent_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; documents without words are copies of nothing and stay."""
    return neardup.one_of_each(docs.select(*COLUMNS))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none and stay."""
    return decontamination.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of them; null and empty texts have a size of 0 and nothing is taken."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", good_quality), ("line_dedup", own_lines), ("near_duplicates", no_near_copies),
    ("decontamination", no_benchmark), ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
