"""Projection, conditional and row-filter helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablework.sources.tables import seeded_digest


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def split_complete(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows without a null, rows with at least one null)."""
    missing = any_null(columns or df.columns)
    return df.where(~missing), df.where(missing)


def split_on(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the condition, all other rows, unknown included)."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def not_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(c) != "")


def regroup(c: Column | str, groups: dict[str, list], other: Column | str | None = None) -> Column:
    """Many values to few; values in no group keep their own text, or become ``other``."""
    c = F.col(c) if isinstance(c, str) else c
    chain = reduce(lambda w, g: w.when(c.isin(groups[g]), F.lit(g)), groups, F)
    if other is None:
        return chain.otherwise(c.cast("string"))
    return chain.otherwise(F.lit(other) if isinstance(other, str) else other)


def in_range_or_null(c: str, low: float, high: float) -> Column:
    return F.when(F.col(c).between(low, high), F.col(c))


def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    """Put a computed column at a position counted from 0."""
    columns = [F.col(c) for c in df.columns]
    return df.select(*columns[:position], value.alias(name), *columns[position:])


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row relation to every row.

    Each value is an uncorrelated scalar subquery: run once, and an error if there is a second row.
    """
    values = one_row.select(F.struct(*one_row.columns).alias("_v")).scalar()
    return df.withColumn("_v", values).select(*df.columns, "_v.*")


def top_random(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows drawn at random (a per-partition top-n, then one merge of n rows per partition), the same in every run."""
    return df.withColumn("_r", seeded_digest(seed, key)).orderBy("_r", key).limit(n).drop("_r")
