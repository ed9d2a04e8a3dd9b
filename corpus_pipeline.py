"""From raw documents to training sequences: five stages, each an operator of `silverlode.llm`.

Every stage works on all rows that the one before it kept and returns the columns of documents
(with cleaned texts, and `n_chars` kept true to them); the last one returns the pieces of packed
sequences. Extra columns travel along untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.llm.decontamination import contamination
from silverlode.llm.line_dedup import drop_boilerplate
from silverlode.llm.near_dedup import near_duplicates
from silverlode.llm.packing import pack
from silverlode.llm.quality_rules import SHORT_LINE, clean_lines

_WORKED_ON = ("doc_id", "text", "source")


def _apply(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The operator's rows with the columns of `docs`; those it does not work on pass it by in
    one struct, so that none can clash with its results."""
    others = [name for name in docs.columns if name not in _WORKED_ON]
    packed = F.struct(*(F.col(f"`{name}`") for name in others)) if others else F.lit(None)
    result = operator(docs.select(*_WORKED_ON, packed.alias("_others")))
    columns = {name: F.col(name) for name in _WORKED_ON} | {
        name: F.col("_others")[name] for name in others
    }
    if "n_chars" in others:
        columns["n_chars"] = F.length("text").cast("long")
    return result.select(*(columns[name].alias(name) for name in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and with them the documents that fail the rules. A boilerplate phrase
    in a long line of other words fails nothing."""
    return _apply(
        docs, lambda rows: clean_lines(rows, short_line=SHORT_LINE).filter("kept")
        .withColumn("text", F.col("cleaned"))
    )


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate on their source go; copies of a page count as one page."""
    return _apply(docs, lambda rows: drop_boilerplate(spark, rows, copies_once=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return _apply(docs, lambda rows: near_duplicates(spark, rows).filter("class_first"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words with a benchmark item, or a shorter item, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apply(
        docs, lambda rows: contamination(spark, rows, benchmark).filter("not contaminated")
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4,096 tokens, with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]

# Near-duplicate classes and packing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    job = Job(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = job.stage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
