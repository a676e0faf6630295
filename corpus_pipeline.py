"""A training corpus from raw documents, stage by stage.

Each stage reads what its predecessor wrote and returns the columns of ``documents``; the last returns the mix
as a list of documents with the number of words to take of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspring.llm import decontaminate, line_quality, mixing, near_dedup, suffix_dedup
from coldspring.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are mostly boilerplate lines go. So do null and empty texts, as they have no words.
    Null and repeated ids do not matter: each row is judged by its text. An empty table stays empty."""
    field = line_quality.fit_lines(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_quality.keep_documents(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 5-word shingles (similarity 0.8 or more) the one with the smallest id stays.
    Documents without an id stay."""
    groups = near_dedup.near_groups(docs, Workspace(spark))
    gone = groups.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has as well are cut out."""
    cut = suffix_dedup.remove_repeats(docs, Workspace(spark), whole=True)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go. Null and empty texts hold none and stay; each row is judged by its text, whatever its
    id. Without documents or without items nothing changes."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: one row per row, also for null and repeated ids. Null and empty texts have no
    words; a null source is a source of its own. An empty table gives an empty table."""
    return mixing.mix_sources(docs, Workspace(spark))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages),
          ("benchmark decontamination", benchmark_leaks), ("mix sources", mix)]

# Learned line labels, signatures and edit distances are not to be written in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again by the next."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
