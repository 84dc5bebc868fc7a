"""Data-quality checks and rejected-row capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull()
    return counts.where((F.col("rows") > 1) | blank)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def null_missing_parent(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Set the child key to null where the parent is gone."""
    keys = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = child.join(keys, F.col(child_key) == F.col("_parent"), "left")
    return joined.withColumn(child_key, F.col("_parent").cast(child.schema[child_key].dataType)).drop("_parent")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: rows in total and rows that break each rule (an unknown outcome breaks it)."""
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *broken)


def load_with_rejects(df: DataFrame, rules: dict[str, Column], unique: list[str] | None = None,
                      order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(loaded rows, rejected rows with a reason).

    ``rules`` hold for a good row. Among rows that meet them, the first row by ``order`` keeps a unique
    key and later ones are rejected; a null key is no duplicate. ``order`` must be unique inside a key.
    """
    broken = F.concat_ws(", ", *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    judged = df.withColumn("reason", broken)
    if unique:
        at = F.struct(*order)
        keyed = F.lit(True)
        for k in unique:
            keyed = keyed & F.col(k).isNotNull()
        firsts = judged.where((F.col("reason") == "") & keyed).groupBy(*unique).agg(F.min(at).alias("_first"))
        judged = judged.join(firsts, unique, "left").withColumn(
            "reason",
            F.when((F.col("reason") == "") & F.col("_first").isNotNull() & (at != F.col("_first")), "duplicate key")
            .otherwise(F.col("reason")),
        )
    judged = judged.select(*df.columns, "reason")
    return judged.where("reason = ''").drop("reason"), judged.where("reason <> ''")


def require_columns(df: DataFrame, allowed: list[str], key: str | None = None) -> DataFrame:
    """Refuse a frame that has columns outside the allowed ones, or lacks its key."""
    extra = sorted(set(df.columns) - set(allowed))
    if extra:
        raise ValueError(f"columns not allowed: {', '.join(extra)}")
    if key and key not in df.columns:
        raise ValueError(f"key column {key} is missing")
    return df
