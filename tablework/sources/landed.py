"""Landed JSON and key/value log files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Separators of the run log, "key ? value|key ? value".
LOG_PAIR_SEP = r"\|"
LOG_VALUE_SEP = r" \? "

NO_JSON = "no JSON"


def read_pages(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """Landed API pages to rows: one row per element of ``response``; pages that report errors are skipped.

    ``errors`` is an empty array on success and an object otherwise, so it is read as text.
    """
    envelope = f"errors string, paging struct<current int, total int>, response array<{row_schema}>"
    pages = spark.read.schema(envelope).json(path)
    good = F.col("errors").isNull() | F.col("errors").isin("[]", "{}", "")
    return pages.where(good).select(
        F.col("paging.current").alias("page"), F.inline("response")
    )


def read_items(spark: SparkSession, path: str, schema: str, array: str, tag_pattern: str, tag: str,
               whole_file: bool = False) -> DataFrame:
    """Nested documents to one row per array element, tagged with a part of the file path.

    ``whole_file`` reads one document per file, otherwise one per line (which splits large files).
    """
    docs = spark.read.schema(schema).option("multiLine", whole_file).json(path)
    return docs.select(
        F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), tag_pattern, 1)).alias(tag), F.inline(array)
    )


def variant_fields(df: DataFrame, text: str, fields: dict[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Fields ``{name: (path, type)}`` of JSON texts of any shape: (rows with the fields, rejected rows with the reason).

    A text is parsed once, without a schema. A field that is missing or null is null; a text that is no JSON, or whose field
    holds something that does not fit its type, is rejected with the names of these fields, instead of becoming null
    without a trace. A null text is kept, all its fields null. Keep ``df`` cheap or stage it: both sides read it.
    """
    parsed = df.withColumn("_v", F.try_parse_json(text))
    values = {name: F.try_variant_get("_v", path, kind) for name, (path, kind) in fields.items()}
    held = {name: F.try_variant_get("_v", path, "variant") for name, (path, _) in fields.items()}
    misfits = F.array_compact(F.array(*[
        F.when(held[name].isNotNull() & ~F.is_variant_null(held[name]) & values[name].isNull(), F.lit(name)) for name in fields]))
    reason = F.when(F.col(text).isNotNull() & F.col("_v").isNull(), F.lit(NO_JSON)).otherwise(F.nullif(F.array_join(misfits, ","), F.lit("")))
    judged = parsed.select(*df.columns, *[v.alias(name) for name, v in values.items()], reason.alias("_reason"))
    good = judged.where("_reason IS NULL").drop("_reason")
    bad = judged.where("_reason IS NOT NULL").select(*df.columns, F.col("_reason").alias("reason"))
    return good, bad


def variant_schema(df: DataFrame, text: str, *by: str) -> DataFrame:
    """The merged schema of all JSON texts, per group: what a reader of them has to expect."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("schema"))


def kv_pairs(line: Column | str) -> Column:
    """Key and value of each pair of a line, in order."""
    parts = F.transform(F.split(line, LOG_PAIR_SEP), lambda p: F.split(p, LOG_VALUE_SEP, 2))
    return F.transform(parts, lambda p: F.struct(F.get(p, F.lit(0)).alias("k"), F.get(p, F.lit(1)).alias("v")))


def read_kv_log(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Log lines to one column per key; a key missing from a line gives null, of a repeated one the last counts."""
    pairs = spark.read.text(path).select(kv_pairs("value").alias("kv"))
    last = lambda k: F.try_element_at(F.filter("kv", lambda p: p["k"] == k), F.lit(-1))["v"]
    return pairs.select(*[F.trim(last(k)).alias(k) for k in keys])


def latest_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole latest row of each key by aggregation, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def append_log(df: DataFrame, path: str, fields: list[str], day: str):
    """Append rows as ``key ? value|...`` lines below one folder per day."""
    line = F.concat_ws("|", *[F.concat(F.lit(f"{c} ? "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in fields])
    df.select(line.alias("value"), F.col(day)).hint("rebalance", day).write.mode("append").partitionBy(day).text(path)
