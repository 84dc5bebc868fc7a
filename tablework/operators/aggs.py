"""Aggregations that combine before the shuffle, so a hot key arrives as a few partial rows."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablework.operators.joins import with_group_value
from tablework.operators.ordered import group_extent, positions, running
from tablework.sources.tables import staged

# Ranks of a quantile sketch are right to one part in so many.
ACCURACY = 10_000
# Factors below 2 whose product is far from the largest double.
LOT = 512
STATISTICS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def keep_last(value: Column, order: Column, how: str = "max", date: bool = False) -> Column:
    """MIN or MAX of ``value`` over the rows that come last by ``order`` (a null order comes last).

    One aggregate over a struct; for MIN the value is negated inside it and turned back.
    """
    ranked = value
    if how == "min":
        ranked = -F.unix_date(value) if date else -value
    best = F.max(F.struct(order.isNull().alias("n"), order.alias("o"), ranked.alias("v")))["v"]
    if how == "min":
        return F.date_from_unix_date(-best) if date else -best
    return best


def first_event(flag: Column, date: Column) -> Column:
    """Earliest date on which the flag is set, null when it never is."""
    return F.min(F.when(flag == 1, date))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole first row of each key; ``order`` must be unique inside a key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def extreme_rows(df: DataFrame, keys: list[str], picks: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Whole rows holding the largest or smallest value of each key, all picked in one pass.

    ``picks`` maps a struct column to (value, tie, "max" or "min"); on equal values the lowest tie (a number) wins.
    Null values are no candidates: the struct is null when a key has no other.
    """
    row = F.struct(*[c for c in df.columns if c not in keys])

    def pick(value, tie, how):
        known = F.col(value).isNotNull()
        if how == "max":
            return F.max_by(row, F.when(known, F.struct(F.col(value), (-F.col(tie)).alias("t"))))
        return F.min_by(row, F.when(known, F.struct(value, tie)))

    return df.groupBy(*keys).agg(*[pick(*p).alias(name) for name, p in picks.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in every column and in all of them together."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    return counted.withColumn("all_columns", total)


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one.

    Texts are compared by length and SHA-256, so that no whole text is a shuffle key.
    """
    kinds = dict(df.dtypes)
    keys = [k for c in columns or df.columns for k in (
        [F.sha2(F.col(c), 256).alias(f"_{c}_digest"), F.length(c).alias(f"_{c}_length")] if kinds[c] == "string" else [F.col(c)])]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], accuracy: int = ACCURACY, **options) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column, without ordering or writing the columns.

    A sketch brackets every quantile between two values whose ranks are at most 6 / ``accuracy`` of the rows apart. One
    more scan counts the rows below each bracket, another the values inside it, combined before the shuffle; only
    these counts are ordered. A bracket that misses its ranks is widened to the whole column.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    wanted = [(i, name, p) for i in range(len(columns)) for name, p in probs.items()]
    edge = 3 / accuracy
    sketch = values.agg(*[F.count(f"v{i}").alias(f"n{i}") for i in range(len(columns))], *[
        F.percentile_approx(f"v{i}", [x for p in probs.values() for x in (max(0.0, p - edge), min(1.0, p + edge))], accuracy).alias(f"q{i}")
        for i in range(len(columns))]).first()
    ranks = {(i, name): (sketch[f"n{i}"] - 1) * p for i, name, p in wanted if sketch[f"n{i}"]}
    brackets = {}
    for k, (i, name, _) in enumerate(wanted):
        if (i, name) in ranks:
            at = 2 * (k % len(probs))
            small = sketch[f"n{i}"] <= accuracy
            brackets[i, name] = (-math.inf, math.inf) if small else tuple(sketch[f"q{i}"][at:at + 2])
    if not brackets:
        return df.sparkSession.createDataFrame([], ", ".join(["column string", *[f"{name} double" for name in probs]]))

    def counted(chosen):
        inside = lambda i, low, high: F.col(f"v{i}").between(F.lit(low), F.lit(high))
        row = values.agg(*[F.count_if(F.col(f"v{i}") < low) for (i, _), (low, _) in chosen.items()],
                         *[F.count_if(inside(i, *b)) for (i, _), b in chosen.items()]).first()
        return {key: (row[k], row[k + len(chosen)]) for k, key in enumerate(chosen)}

    counts = counted(brackets)
    missed = {key: (-math.inf, math.inf) for key, (below, within) in counts.items()
              if below > math.floor(ranks[key]) or below + within <= math.ceil(ranks[key])}
    if missed:
        brackets |= missed
        counts |= counted(missed)
    keys = list(brackets)
    hits = F.array(*[F.when(F.col(f"v{i}").between(F.lit(low), F.lit(high)), F.struct(F.lit(k).alias("at"), F.col(f"v{i}").alias("v")))
                     for k, ((i, _), (low, high)) in enumerate(brackets.items())])
    inside = values.select(F.inline(F.filter(hits, lambda h: h.isNotNull()))).groupBy("at", "v").agg(F.count(F.lit(1)).alias("n"))
    asked = df.sparkSession.createDataFrame(
        [(k, columns[i], name, counts[i, name][0], float(ranks[i, name])) for k, (i, name) in enumerate(keys)],
        "at int, column string, name string, below long, rank double")
    ranked = running(inside, ["at"], ["v"], {"upto": ("sum", F.col("n"))}, **options)
    # one row per column and quantile that was asked for
    ranked = ranked.join(F.broadcast(asked), "at").withColumn("upto", F.col("upto") + F.col("below"))
    share = F.col("rank") - F.floor("rank")
    holds = lambda r: (F.col("upto") - F.col("n") <= r) & (F.col("upto") > r)
    low = F.sum(F.when(holds(F.floor("rank")), F.col("v") * (1 - share)))
    high = F.sum(F.when(holds(F.ceil("rank")), F.col("v") * share))
    found = ranked.groupBy("column", "name").agg((low + high).alias("q"))
    return found.groupBy("column").agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in probs])


def describe(df: DataFrame, columns: list[str], **options) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    spark = df.sparkSession
    stats = [f(F.col(c).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in STATISTICS.items()]
    row = df.agg(*stats).first()
    rows = [(c, *[row[f"{name}{i}"] for name in STATISTICS]) for i, c in enumerate(columns)]
    plain = spark.createDataFrame(rows, "column string, count long, mean double, std double, min double, max double")
    return plain.join(exact_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, **options), "column", "left")


def pivot_sum(df: DataFrame, by: list[str], code: str, value: str, codes: list) -> DataFrame:
    """One column per listed code with the sum of its values."""
    return df.groupBy(*by).pivot(code, codes).agg(F.sum(value))


def ordered_lists(df: DataFrame, keys: list[str], value: str, order: list[str], page_rows: int = 10_000,
                  **options) -> DataFrame:
    """Distinct values of a key in first-seen order, in numbered pages of ``page_rows`` values."""
    seen = df.groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_at"))
    numbered = positions(seen, keys, ["_at"], "_pos", **options).withColumn("page", F.floor(F.col("_pos") / page_rows))
    items = F.array_sort(F.collect_list(F.struct("_pos", F.col(value).alias("v"))))
    return numbered.groupBy(*keys, "page").agg(F.transform(items, lambda i: i["v"]).alias("values"))


def letter_sets(words: DataFrame, word: str) -> DataFrame:
    """Distinct words with the set of their letters, and how many words (and uses) share that set."""
    letters = F.array_join(F.array_sort(F.array_distinct(F.split(word, ""))), "")
    distinct = words.groupBy(word).agg(F.count(F.lit(1)).alias("uses")).withColumn("letters", letters)
    # both sides of the join back need the same columns, so the word count is shuffled once and reused
    return with_group_value(
        distinct, ["letters"], F.count(F.lit(1)).alias("words_in_set"), F.sum("uses").alias("uses_in_set"), null_keys=False)


def frequency_of_frequency(df: DataFrame, value: str) -> DataFrame:
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("frequency"))
    return counts.groupBy("frequency").agg(F.count(F.lit(1)).alias("values"))


def products(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, _m, _e, _z): the product of the non-zero values per key as _m * 2 ** _e, and the number of zeros.

    Values are split into a factor near 1 and a power of two, without rounding. Factors are multiplied in lots of ``LOT`` and
    split again, so no product leaves the range of doubles on the way, whatever the values. Without non-zero values
    the product is 1; null values are left out; an infinite value or NaN makes it NaN.
    """
    largest = group_extent(df, keys)[0]
    parts = df.select(*keys, F.col(value).cast("double").alias("_m"), F.lit(0).cast("long").alias("_e"),
                      (F.col(value) == 0).cast("long").alias("_z"))
    while True:
        scale = F.floor(F.log2(F.abs("_m")))
        split = F.when(F.col("_m") != 0, F.col("_m") / F.pow(F.lit(2.0), scale))
        parts = parts.withColumns({"_m": split, "_e": F.col("_e") + F.when(F.col("_m") != 0, scale).otherwise(0)})
        # rows are dealt out in turn: a key of the largest size has half of LOT rows in each lot
        lots = [] if largest <= LOT else [F.pmod(F.monotonically_increasing_id(), F.lit(math.ceil(2 * largest / LOT))).alias("_lot")]
        parts = parts.groupBy(*keys, *lots).agg(
            F.coalesce(F.product("_m"), F.lit(1.0)).alias("_m"), F.sum("_e").alias("_e"), F.sum(F.coalesce("_z", F.lit(0))).alias("_z"))
        if not lots:
            return parts
        parts = staged(parts.drop("_lot"), "lots")
        largest = group_extent(parts, keys)[0]


def product_of_others(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Product of all other values of the key: with one zero only its own row is non-zero, with more none is."""
    v = F.col(value).cast("double")
    groups = products(df, keys, value).withColumnsRenamed({k: f"_group_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
    # a power of two beyond the doubles is applied in two halves
    scale = F.floor(F.log2(F.abs(v)))
    without = lambda m, e: m * F.pow(F.lit(2.0), F.floor(e / 2)) * F.pow(F.lit(2.0), e - F.floor(e / 2))
    others = without(F.col("_m") / F.nullif(v / F.pow(F.lit(2.0), scale), F.lit(0.0)), F.col("_e") - scale)
    result = F.when(F.col("_z") == 0, others).when((F.col("_z") == 1) & (v == 0), without(F.col("_m"), F.col("_e"))).otherwise(F.lit(0.0))
    return df.join(groups, on).withColumn(name, result).select(*df.columns, name)
