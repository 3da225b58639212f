"""From raw documents to packed sequences: quality, lines, near duplicates, benchmarks, packing.

Each stage works on all that the one before kept. All but the last return the columns of `documents`, and others that the
table has, as they are. No documents give no rows; rows that repeat are rows of their own until near duplicates are dropped,
where those of one doc_id stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweb.llm.decontaminate import drop_contaminated
from tallyweb.llm.line_dedup import drop_repeated_lines
from tallyweb.llm.ngram_join import keep_one_of_each
from tallyweb.llm.packing import pack_digest
from tallyweb.llm.quality_rules import keep_good, train_quality
from tallyweb.llm.queries import table, tokenizer_path
from tallyweb.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted rules take to be good; null texts are judged as empty ones."""
    return keep_good(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many share; null texts become empty, and n_chars is counted anew."""
    out = drop_repeated_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest doc_id; documents without words all stay."""
    return keep_one_of_each(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; without items, all."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; a null or empty text is one piece of one token."""
    return pack_digest(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmarks", benchmarks),
    ("packing", packing),
]

#: SQL knows neither the fitted rules nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
