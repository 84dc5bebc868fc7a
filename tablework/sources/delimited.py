"""Delimited, fixed-width and line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablework.functions.text import strip_cr
from tablework.operators.ordered import running


# Quotes inside a quoted field are doubled, and blanks at the ends of a field belong to it, for readers and writers alike.
_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Stands for a quoted empty field while a file is read: Spark would take it for the unquoted one, which is null.
_EMPTY = "\u0001empty\u0001"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False,
                   columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Read with a declared schema; ``columns`` keeps only some fields (pruned in the scan).

    Texts come back as they were written, an empty one quoted and null as nothing. ``multi_line`` reads quoted fields with line
    breaks; a file is then one task, so write many files of moderate size.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("multiLine", multi_line)
    df = reader.options(**_TEXT, emptyValue=_EMPTY).csv(path)
    df = df.select(*columns) if columns else df
    return df.select(*[F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False, mode: str = "errorifexists", **options):
    """Fields are quoted where they need it; ``options`` go to the writer (for example maxRecordsPerFile)."""
    df.write.mode(mode).option("sep", sep).option("header", header).options(**_TEXT, **options).csv(path)


def write_lines(df: DataFrame, path: str, sep: str = "\t", end: str = ""):
    """Plain lines, fields parted by ``sep`` and never quoted, null as nothing; ``end`` comes before each line break."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat(F.concat_ws(sep, *fields), F.lit(end)).alias("value")).write.text(path)


def read_tab_fields(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    """Tab-separated fields by name; a stray carriage return at the end of a line is dropped."""
    df = read_delimited(spark, path, schema, sep="\t", columns=columns)
    return df.select(*[strip_cr(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, tuple[int, int]]) -> DataFrame:
    """Cut named fields ``{name: (first character from 1, length)}`` out of each line, blanks trimmed."""
    lines = spark.read.text(path)
    return lines.select(*[F.trim(F.substring("value", at, n)).alias(c) for c, (at, n) in fields.items()])


def write_partitioned(df: DataFrame, path: str, keys: list[str], **options):
    """One folder per key value. Rows are rebalanced by key: small keys share a task, a hot key is split."""
    writer = df.hint("rebalance", *keys).write.partitionBy(*keys)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.csv(path)


def numbered_lines(df: DataFrame, name: str = "line") -> DataFrame:
    """Number the rows of a file scan from 0 in file order.

    Spark reads files in splits. A row is placed by (file, split start, order inside the split); only a
    count per split is summed up over the whole input.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = placed.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    offsets = running(splits, [], ["_file", "_start"], {"_before": ("sum", F.col("_n"))}, earlier=True)
    # ids grow by one inside a split, so the distance to the split's first id is the row's place in it
    return (
        placed.join(offsets.drop("_n"), ["_file", "_start"])
        .withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_id") - F.col("_first"))
        .drop("_file", "_start", "_id", "_first", "_before")
    )


def zip_join(*frames: DataFrame) -> DataFrame:
    """Join file scans n-th row to n-th row; a shorter file leaves nulls."""
    joined = numbered_lines(frames[0])
    for other in frames[1:]:
        joined = joined.join(numbered_lines(other), "line", "full")
    return joined
