"""Sort, set operations, exploding and resampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablework.operators.ordered import shifted


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(n)


def explode_text(df: DataFrame, column: str, sep: str, name: str) -> DataFrame:
    """One row per trimmed item of a delimited string."""
    return df.withColumn(name, F.explode(F.split(column, sep))).withColumn(name, F.trim(name))


def resample_last(df: DataFrame, keys: list[str], date: str, values: list[str], tie: list[str] | None = None) -> DataFrame:
    """Last non-null value of each column per month end; months without rows are kept with nulls."""
    at = [F.col(date), *[F.col(t) for t in tie or []]]
    last = [
        F.max(F.when(F.col(v).isNotNull(), F.struct(*at, F.col(v).alias("_v"))))["_v"].alias(v) for v in values
    ]
    monthly = df.groupBy(*keys, F.last_day(date).alias("month_end")).agg(*last)
    # each month is spread up to the month before the next one; a key has one row per calendar month
    led = shifted(monthly, keys, ["month_end"], {"_next": (F.col("month_end"), -1)}, bounded=bool(keys))
    until = F.coalesce(F.add_months("_next", -1), F.col("month_end"))
    starts = F.sequence(F.trunc("month_end", "month"), F.trunc(until, "month"), F.expr("interval 1 month"))
    spread = led.select("*", F.posexplode(starts).alias("_i", "_start"))
    return spread.select(
        *keys, F.last_day("_start").alias("month_end"), *[F.when(F.col("_i") == 0, F.col(v)).alias(v) for v in values])


def drop_last_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """Leave out the rows of the n highest group values (for example partial years).

    The frame is read twice; hand over a written one when it is costly to compute.
    """
    last = df.select(group).distinct().orderBy(F.col(group).desc()).limit(n)
    return df.join(last, group, "left_anti")


def undirected_edges(adjacency: DataFrame, node: str, neighbours: str) -> DataFrame:
    """Adjacency lists to distinct edges with ``a <= b``."""
    pairs = adjacency.select(F.col(node).alias("x"), F.explode(neighbours).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """Number of edges at each node; an edge from a node to itself counts once."""
    ends = edges.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def missing_columns(df: DataFrame, allowed: list[str]) -> list[str]:
    """Columns of a frame that are not in the allowed list."""
    return sorted(set(df.columns) - set(allowed))
