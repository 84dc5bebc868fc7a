"""From raw documents to a mixed training corpus: five stages, each written and read back before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablework.llm.decontaminate import drop_contaminated
from tablework.llm.language_id import keep_identified
from tablework.llm.line_dedup import drop_repeated_lines
from tablework.llm.mixing import mixture
from tablework.llm.simhash_dedup import keep_one
from tablework.session import scratch_path, table, tune


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network recognises; the model learns from this stage's own input."""
    return keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that an earlier one has; n_chars follows the text."""
    cleaned = drop_repeated_lines(docs).drop("lines_dropped")
    return cleaned.selectExpr(*["char_length(text) AS n_chars" if c == "n_chars" else f"`{c}`" for c in cleaned.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, at most 2 differing bits."""
    return keep_one(docs, words_per_shingle=3, max_distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and output shards of every document, sources at their target weights."""
    return mixture(docs).drop("row")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
]

# A trained network, fingerprints and edit distances are beyond SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
