"""Corpus preparation: quality rules, near duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutlens.llm import decontamination, packing, quality, similar, suffix_dedup
from debutlens.llm.common import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules (6) keep.

    Null and empty texts go, for they have no words; repeated rows get equal verdicts; null languages are one
    language; an empty table gives no rows; other columns, whatever their names, stay as they are.
    """
    return quality.judge_quality(docs).filter("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (7; 5-word similarity of 0.8 or more): the smallest id.

    Fingerprints find the first pairs, shared shingles those that fingerprints miss. Null and empty texts are
    copies of each other, repeated rows too; null ids come after all others; an empty table gives no rows; other
    columns stay as they are.
    """
    return similar.one_of_each_group(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes that an earlier one holds (3); n_chars, if there, follows the text.

    Null texts become empty, as may whole copies; rows that repeat an id lose nothing to each other; null ids
    come last; an empty table gives no rows; other columns, whatever their names, stay as they are.
    """
    kept = suffix_dedup.remove_repeats(docs).select("rest", F.col("kept_text").alias("text"))
    own = {"text": F.col("text"), "n_chars": F.length("text")}
    return kept.select(*[own.get(c, F.col("rest")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (1).

    Null and empty texts hold none and stay; repeated rows are judged each; an empty table on either side gives
    no rows or no hits; other columns stay as they are.
    """
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences (2).

    Null and empty texts are one end token; repeated rows give pieces each; an empty table gives no rows; other
    columns are left out.
    """
    return packing.packing_query(spark, sf_dir, docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

#: SimHash components, byte-pair tokens and best-fit places can't be said in SQL; a test compares run() with a
#: plain version of all five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
