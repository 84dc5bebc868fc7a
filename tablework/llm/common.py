"""What the operators share: staged tables, row ids, word counts, safe column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablework.session import scratch_path

# A word is a run of bytes that are neither a blank nor one of \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
# Rows and bytes of one Arrow batch: bound what a Python worker holds, since a text may have 100,000 characters and more.
BATCH_ROWS = "1000"
BATCH_BYTES = "32m"
# Plans in which a row keeps the file and the place it was read from.
_PLAIN_SCAN = re.compile(r"(Project|Filter|Relation)\b")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators with Python tasks rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later uses and lost executors read files, not a lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself when it is a plain scan of files, else a staged copy: rows of files can be told apart for good."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.lstrip(" +-:") for line in plan.splitlines() if line.strip()]
    return df if all(_PLAIN_SCAN.match(line) for line in lines) else stage(df, name)


def row_id(scan: DataFrame) -> Column:
    """Id of a row of a ``settled`` frame: its file and its place there.

    The same in every job, whatever the partitioning; numbers that follow the partitioning would change when an
    executor is lost between two jobs.
    """
    place = scan.metadataColumn("_metadata")
    return F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("index"))


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names, so other columns cannot clash with them."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def picked_rows(scan: DataFrame, **columns: str) -> DataFrame:
    """``picked`` with the row id in front, as ``row``."""
    return scan.select(row_id(scan).alias("row"), *[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids have none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
