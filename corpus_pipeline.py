"""From raw documents to a training mix, in five stages.

    toxicity           documents that the classifier rejects go
    near_duplicates    of each group of near-copies the smallest id stays
    repeated_passages  passages of 50 words and more that an earlier document keeps are cut
    decontamination    documents that overlap a benchmark item go
    mixture            rows are repeated or left out so that sources reach their weights

Each stage takes what its predecessor kept, written as Parquet and read again, and
returns the columns of documents.

Defined results: rows with a null text or id pass the first four stages (nothing is known
against them) and count 0 words in the mixture; empty texts are copies of each other, and of
copies, as of repeated rows, one stays; a null source is a source of its own. Two texts under
one id are judged, cut and dropped each by itself. Texts of any length are read whole, other
columns are carried under any name, and an empty table passes empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riftlog.llm import dart_minhash, decontaminate, mixing, suffix_dedup, toxicity
from riftlog.llm.queries import table
from riftlog.session import settle

REJECT = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels outside the held-out fold, scores every document."""
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("toxicity") < REJECT).select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(docs, length_col="n_chars")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"), clean_only=True).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("repeated_passages", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("mixture", mixture),
]

#: Trained scores, similarity groups and cut texts have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
