"""Corpus pipeline: quality rules, line dedup, near-dedup, suffix-array dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgate.llm.common import stored
from lexgate.llm.line_dedup import dedup_lines
from lexgate.llm.near_dedup import drop_near_copies
from lexgate.llm.packing import pack_documents
from lexgate.llm.quality_rules import keep_quality
from lexgate.llm.substring_dedup import strip_repeated_bytes

_BLANK = " \t\n\x0b\x0c\r"


def _worded(docs: DataFrame) -> DataFrame:
    """Rows that still hold a word, with n_chars of the new text."""
    return docs.where(F.length(F.trim("text", F.lit(_BLANK))) > 0).withColumn("n_chars", F.length("text").cast("long"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rules learn from the labels of the same folder.

    Null and empty texts fail the base rule and go. Rows that share an id are judged each by its own text; labels
    of a null id are ignored. An empty table gives no rows; other columns stay, whatever their names.
    """
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; texts without a word left go, null ones too.

    The first place of a line stays (null ids first); rows that share an id each lose lines of their own text. n_chars is that of
    the new text, also where it was null. An empty table gives no rows.
    """
    return _worded(dedup_lines(docs).select(*docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id (null ids first), of each group of near-duplicates (five words, similarity 0.8).

    Documents without words all stay; rows that share an id are judged each by its own text.
    """
    return drop_near_copies(docs).select(*docs.columns)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings of 100 that start earlier; texts without a word left go, null ones too.

    A character goes when all its bytes do. Null ids count as the least; rows that share an id lose nothing to each other. An
    empty table gives no rows.
    """
    return _worded(strip_repeated_bytes(docs)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens; each row is a document, null text counts as empty."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", near_stage),
    ("suffix-array dedup", suffix_stage),
    ("packing", packing_stage),
]

#: Trees, packing and suffix ranks have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
