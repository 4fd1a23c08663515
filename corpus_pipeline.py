"""A corpus pipeline: from documents to encoded text, in stages that each write Parquet.

Every stage reads what the one before it kept and works on all of it; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, mixing, quality, sentencepiece, substrings
from tidemark.session import stored

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that their host repeats."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8."""
    return jaccard.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the longer sentences and lines that an earlier one holds."""
    return substrings.documents(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights; a document taken twice is two rows."""
    return mixing.Mix(docs).documents()


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with its texts as piece ids."""
    return sentencepiece.encoded(docs, sentencepiece.Model.read(PIECES))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", source_mixing),
    ("SentencePiece", encoding),
]

# Packing, drawing and encoding are not expressible; tests/llm compares stages 2 and 3 with
# versions by brute force, the words and uses of 4, the rows of 5, and the ids that 1 keeps
# with its operator, whose query has SQL. The texts of 1 are not compared.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
