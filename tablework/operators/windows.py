"""Ranking, running and run-length operators over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablework.operators.ordered import fits, positions, rolling, running, shifted

# Ids written out from one row of a gap.
GAP_PIECE = 100_000


def line_ids(df: DataFrame, order: list, prefix: Column, name: str, width: int = 6) -> DataFrame:
    """``prefix-000001`` ids over the whole table, numbered without a one-task window."""
    numbered = positions(df, [], order, "_pos")
    number = (F.col("_pos") + 1).cast("string")
    padded = F.lpad(number, F.greatest(F.lit(width), F.length(number)), F.lit("0"))
    return numbered.withColumn(name, F.concat(prefix, F.lit("-"), padded)).drop("_pos")


def global_rank(df: DataFrame, order: list, name: str, start: int = 1) -> DataFrame:
    return positions(df, [], order, "_pos").withColumn(name, F.col("_pos") + start).drop("_pos")


def period_change(df: DataFrame, keys: list[str], period: str, values: list[str]) -> DataFrame:
    """Previous value, difference and percent change per period; the input has one row per key and period."""
    lagged = shifted(df, keys, [period], {f"last_{v}": (F.col(v), 1) for v in values}, bounded=True)
    made = {}
    for v in values:
        now, last = F.col(v), F.col(f"last_{v}")
        made[f"{v}_diff"] = F.when(last >= 0, now - last)
        made[f"{v}_pct"] = F.coalesce((now - last) / F.nullif(last, F.lit(0)), F.lit(0.0)) * 100
    return lagged.withColumns(made)


def rolling_sum(df: DataFrame, keys: list[str], order: list, value: str, n: int, name: str, **options) -> DataFrame:
    return rolling(df, keys, order, n, {name: ("sum", F.col(value))}, **options)


def latest_move(df: DataFrame, keys: list[str], order: list[str], value: str, threshold: float) -> DataFrame:
    """Keys whose latest value moved by more than a share of the one before, with direction and percent.

    Only the two latest rows per key leave a task (the rank limit is applied before the shuffle).
    """
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    two = df.withColumn("_rn", F.row_number().over(w)).where("_rn <= 2")
    pair = two.groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(value))).alias("latest"),
        F.max(F.when(F.col("_rn") == 2, F.col(value))).alias("previous"))
    change = F.col("latest") - F.col("previous")
    return pair.where(F.abs(change) > threshold * F.col("previous")).select(
        *keys, "latest", "previous", F.when(change > 0, "up").otherwise("down").alias("direction"),
        F.round(F.abs(change / F.col("previous")) * 100, 4).alias("percent"))


def top_distinct(df: DataFrame, value: str, n: int, keys: list[str] | None = None) -> DataFrame:
    """The n largest distinct values, over all rows or per key."""
    distinct = df.select(*(keys or []), value).where(F.col(value).isNotNull()).distinct()
    if not keys:
        return distinct.orderBy(F.col(value).desc()).limit(n)
    w = W.partitionBy(*keys).orderBy(F.col(value).desc())
    return distinct.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def kth_smallest(df: DataFrame, keys: list[str], value: str, tie: list[str], k: int, distinct: bool = False) -> DataFrame:
    """Row with the k-th smallest value per key, or the k-th smallest distinct value."""
    if distinct:
        df, tie = df.select(*keys, value).distinct(), []
    w = W.partitionBy(*keys).orderBy(value, *tie)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == k).drop("_rn")


def running_max(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, **options) -> DataFrame:
    return running(df, keys, order, {name: ("max", F.col(value))}, **options)


def best_gain(df: DataFrame, keys: list[str], order: list[str], value: str, **options) -> DataFrame:
    """Largest later-minus-earlier difference per key, at least 0."""
    low = running(df.select(*keys, *order, value), keys, order, {"_low": ("min", F.col(value))}, **options)
    return low.groupBy(*keys).agg(F.greatest(F.lit(0.0), F.max(F.col(value) - F.col("_low"))).alias("gain"))


def best_run_sum(df: DataFrame, keys: list[str], order: list[str], value: str, group_rows: int | None = None) -> DataFrame:
    """Largest sum of a contiguous, non-empty run of rows per key: prefix sum minus the lowest earlier one."""
    options = {"bounded": fits(df, keys, group_rows=group_rows), "group_rows": group_rows}
    prefix = running(df.select(*keys, *order, value), keys, order, {"_sum": ("sum", F.col(value))}, **options)
    low = running(prefix, keys, order, {"_low": ("min", F.col("_sum"))}, earlier=True, **options)
    best = F.col("_sum") - F.least(F.lit(0), F.coalesce("_low", F.lit(0)))
    return low.groupBy(*keys).agg(F.max(best).alias("best"))


def zero_runs(df: DataFrame, keys: list[str], order: list[str], value: str, **options) -> DataFrame:
    """Runs of zeros per key and the number of contiguous zero stretches they contain."""
    zero = F.col(value) == 0
    marked = running(df.select(*keys, *order, value), keys, order,
                     {"_run": ("sum", F.when(zero, 0).otherwise(1))}, **options)
    runs = marked.where(zero).groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("n"))
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.max("n").alias("longest"),
        F.sum(F.floor(F.col("n") * (F.col("n") + 1) / 2)).alias("stretches"))


def missing_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids between the lowest and the highest one that do not occur.

    Only the gaps between neighbouring ids are written out, in pieces of ``GAP_PIECE`` ids.
    """
    present = df.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    gaps = shifted(present, [], [id_col], {"_next": (F.col(id_col), -1)}).where(F.col("_next") - F.col(id_col) > 1)
    first, last = F.col(id_col) + 1, F.col("_next") - 1
    pieces = gaps.select(F.explode(F.sequence(first, last, F.lit(GAP_PIECE).cast("bigint"))).alias("_from"), last.alias("_last"))
    return pieces.select(F.explode(F.sequence("_from", F.least(F.col("_from") + GAP_PIECE - 1, F.col("_last")))).alias(id_col))


def target_windows(df: DataFrame, keys: list[str], order: list[str], value: str, target,
                   group_rows: int | None = None) -> DataFrame:
    """Rows that end a contiguous window summing to ``target``: how many such windows and the nearest start.

    A window from i to j sums to the target when the sum before i plus the target equals the sum up to j.
    Starts and ends meet under that common number and a running count matches them, so the work is linear
    and no list of pairs is produced. A null value counts as 0: its row can start, end or lie inside a window.
    """
    df = df.withColumn(value, F.coalesce(value, F.lit(0)))
    # every row is one start and one end
    options = {"bounded": fits(df, keys, rows_per_row=2, group_rows=group_rows), "group_rows": group_rows}
    rows = running(df.select(*keys, *order, value), keys, order,
                   {"_sum": ("sum", F.col(value)), "_at": ("count", F.lit(1))}, **options)
    start = F.struct((F.col("_sum") - F.col(value) + target).alias("_meet"), F.lit(0).alias("_side"), F.lit(1).alias("_start"))
    end = F.struct(F.col("_sum").alias("_meet"), F.lit(1).alias("_side"), F.lit(0).alias("_start"))
    marks = rows.select(*keys, "_at", F.inline(F.array(start, end)))
    met = running(marks, [*keys, "_meet"], ["_at", "_side"],
                  {"windows": ("sum", F.col("_start")),
                   "nearest_start": ("last", F.when(F.col("_start") == 1, F.col("_at")))}, **options)
    return met.where("_side = 1 AND windows > 0").select(*keys, F.col("_at").alias("end"), "windows", "nearest_start")


def has_duplicates(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: does any value occur more than once?"""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg((F.max("n") > 1).alias("has_duplicates"))
