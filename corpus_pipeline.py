"""A training corpus from raw documents: five stages, each an operator of lodestrata.llm.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns a DataFrame, which is written as Parquet and read again for the next one. All but the
last return the columns of documents.

Defined cases: a null, empty or letterless text has no language and goes in the first stage; a null lang teaches nothing; a null
source is a source of its own; a null doc_id is never a near duplicate; rows that repeat a doc_id are one
document from the third stage on; an empty table gives an empty result; extra columns are carried to the fourth stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import language_id, mixing, near_dedup, packing, quality_rules
from lodestrata.llm.storage import Workspace, load, scope

LEAST_LANGUAGE_SCORE = 4 / language_id.DIMENSIONS**0.5
"""Four standard deviations of the cosine of unrelated vectors. Clean texts of one or two short words can lie below it."""
ORACLE_SQL = None
"""Random vectors, rounding draws and packing order are not SQL; a test holds run() against brute force."""


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: a letter, and a cosine with some language's profile above noise, the same at every size."""
    learned, score = language_id.model(language_id.learn(docs)), "__language_score"
    return language_id.with_score(docs, learned, score).where(F.col(score) >= LEAST_LANGUAGE_SCORE).drop(score)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.filter_quality(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their bins."""
    packed = packing.pack(docs)
    return packed.select("doc_id", "piece", "start_word", "n_words", "bin_id", "bin_offset", "source")


STAGES = [("language_id", language), ("quality_rules", quality), ("near_dedup", dedup), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Tables of a stage, and those of the stage before it, are deleted once its rows are written."""
    work = Workspace(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scope(spark):
            kept = work.table(stage(spark, docs, sf_dir), name)
        work.drop(docs)
        docs = kept
    return docs
