"""Joins beyond a plain equi join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablework.functions.dates import shift_months
from tablework.operators.ordered import positions, running, shifted
from tablework.sources.tables import staged


def year_over_year(df: DataFrame, keys: list[str], date: str, values: list[str], months: int = 12,
                   prefix: str = "last_") -> DataFrame:
    """Add each row's values of the same key ``months`` earlier (month ends match month ends).

    The input has one row per key and date. Each row is emitted for its own date and for the date it is
    compared with; the two meet as neighbours in date order. That reads the input once and shuffles it
    once on the key, where a self join would do both twice. Of several dates that fall on one a year later
    (28 and 29 February) the latest counts; null keys and null dates have no partner.
    """
    own = F.struct(F.col(date).alias("_at"), F.lit(1).alias("_side"))
    later = F.struct(shift_months(date, months).alias("_at"), F.lit(0).alias("_side"))
    rows = df.select("*", F.inline(F.array(own, later)))
    before = F.struct(date, *values, "_at", "_side")
    paired = shifted(rows, keys, ["_at", "_side", date], {"_before": (before, 1)}, bounded=True)
    found = (F.col("_before._side") == 0) & (F.col("_before._at") == F.col("_at"))
    for k in keys:
        found = found & F.col(k).isNotNull()
    return paired.where("_side = 1").select(
        *df.columns, *[F.when(found, F.col(f"_before.{c}")).alias(f"{prefix}{c}") for c in [date, *values]])


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_date: str, right_date: str,
              right_tie: str | None = None, **options) -> DataFrame:
    """Left rows with the latest right row of the same key dated on or before them.

    Both sides go into one table ordered by date, statements before reports on the same date, and each
    report takes the last statement seen: one shuffle on the key, no pairs. Among statements of one date
    the highest ``right_tie`` counts. As in an equi join, a null key or date on either side matches nothing.
    ``options`` go to :func:`running` (a hot key is spread there).
    """
    right = right.na.drop(subset=[*keys, right_date])
    right_rest = [c for c in right.columns if c not in keys]
    left_rest = [c for c in left.columns if c not in keys]
    statement = F.struct(*[F.col(c) for c in right_rest])
    report = F.struct(*[F.col(c) for c in left_rest])
    tie = F.col(right_tie) if right_tie else F.lit(None).cast("int")
    tie_type = right.select(tie.alias("t")).schema["t"].dataType
    rows = left.select(
        *keys, F.col(left_date).alias("_at"), F.lit(1).alias("_side"), report.alias("_left"),
        F.lit(None).cast(right.select(statement.alias("s")).schema["s"].dataType).alias("_right"),
        F.lit(None).cast(tie_type).alias("_tie"),
    ).unionByName(right.select(
        *keys, F.col(right_date).alias("_at"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(report.alias("r")).schema["r"].dataType).alias("_left"),
        statement.alias("_right"),
        tie.alias("_tie"),
    ))
    found = running(rows, keys, ["_at", "_side", "_tie"], {"_found": ("last", F.col("_right"))}, **options)
    return found.where("_side = 1").select(*keys, "_left.*", *[F.col(f"_found.{c}").alias(c) for c in right_rest])


def on_or_before(reports: DataFrame, daily: DataFrame, report_date: str, date: str, aggregates: list[Column]) -> DataFrame:
    """Aggregate, for every report date, all rows of ``daily`` dated on or before it.

    Both inputs hold at most one row per calendar day, so spreading each report over the months up to it
    is bounded by the calendar. The join is an equi join on the month, the date test a residual.
    """
    first = daily.select(F.trunc(F.min(date), "month")).scalar()
    months = F.explode(F.sequence(first, F.trunc(report_date, "month"), F.expr("interval 1 month")))
    spread = reports.where(F.trunc(report_date, "month") >= first).select("*", months.alias("_month"))
    placed = daily.withColumn("_month", F.trunc(date, "month"))
    matched = spread.join(placed, "_month").where(F.col(date) <= F.col(report_date))
    return matched.groupBy(*reports.columns).agg(*aggregates)


def _whole(df: DataFrame, name: str) -> Column:
    """A date, timestamp or whole number as a long: days, microseconds or the number."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.unix_date(name).cast("long")
    return F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name).cast("long")


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, start: str, end: str) -> DataFrame:
    """Every pair of a point and an interval of the same keys that holds it, bounds included.

    An interval goes to the one or two bins it touches among bins at least as wide as itself, the next power of two; a
    point goes to its bin of every width that occurs (64 at most). So short and long intervals are copied alike, a pair
    meets in one bin only, and the join is an equi join on keys, width and bin with the bounds as a residual; Spark
    splits a hot bin. Null keys, points and bounds match nothing. Beside the keys the two sides share no column name.
    """
    placed = intervals.na.drop(subset=[*keys, start, end]).withColumns({"_start": _whole(intervals, start), "_end": _whole(intervals, end)})
    placed = placed.where("_start <= _end").withColumn("_width", F.expr("if(_end = _start, 0, length(bin(_end - _start)))"))
    widths = sorted(r[0] for r in placed.select("_width").distinct().collect())
    placed = placed.withColumn("_bin", F.explode(F.expr("array_distinct(array(shiftright(_start, _width), shiftright(_end, _width)))")))
    spread = points.na.drop(subset=[*keys, point]).withColumn("_point", _whole(points, point)).withColumn(
        "_width", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")))
    spread = spread.withColumn("_bin", F.expr("shiftright(_point, _width)"))
    met = spread.join(placed, [*keys, "_width", "_bin"]).where("_point BETWEEN _start AND _end")
    return met.drop("_start", "_end", "_width", "_bin", "_point")


def new_rows(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, one for each key: the least by its other columns in order.

    Null keys count as one key that is never stored.
    """
    rest = [c for c in incoming.columns if c not in keys]
    once = incoming.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*") if rest else incoming.distinct()
    return once.join(stored.select(*keys), keys, "left_anti").select(*incoming.columns)


def first_appearances(membership: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Memberships that were not there in the period before (one row per key and period once distinct)."""
    present = membership.select(*keys, period).distinct()
    lagged = shifted(present, keys, [period], {"_last": (F.col(period), 1)}, bounded=True)
    return lagged.where(F.col("_last").isNull() | (F.col(period) - F.col("_last") > 1)).drop("_last")


def with_group_value(df: DataFrame, keys: list[str], *aggregates: Column, few_groups: bool = False,
                     null_keys: bool = True) -> DataFrame:
    """Group aggregates joined back to the detail rows.

    The aggregate is combined before its shuffle; the join back splits a hot key (adaptive skew join),
    which a window over the key could not. With ``few_groups`` the groups are written first: the planner
    then knows their size, and when they really are few it broadcasts them and leaves the detail rows
    where they are. Rows with null keys form groups of their own; ``null_keys=False`` states that there are none.
    """
    groups = df.groupBy(*keys).agg(*aggregates)
    groups = staged(groups, "groups") if few_groups else groups
    if not null_keys:
        return df.join(groups, keys)
    renamed = groups.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    return df.join(renamed, on).drop(*[f"_group_{k}" for k in keys])


def matches_per_key(df: DataFrame, keys: list[str], value: str, order: list, sep: str = "\n",
                    page_rows: int = 10_000, **options) -> DataFrame:
    """All values of a key joined to text, in order, in numbered pages of ``page_rows`` values.

    A key of ordinary size fills page 0 only; a hot key continues on further pages.
    """
    numbered = positions(df, keys, order, "_pos", **options).withColumn("page", F.floor(F.col("_pos") / page_rows))
    parts = F.array_sort(F.collect_list(F.struct("_pos", F.col(value).cast("string").alias("v"))))
    return numbered.groupBy(*keys, "page").agg(
        F.array_join(F.transform(parts, lambda p: p["v"]), sep).alias("joined"), F.count(F.lit(1)).alias("values"))


def pair_sums(df: DataFrame, id_col: str, value: str, target) -> DataFrame:
    """Value pairs that add up to a target: how many row pairs, and the lowest ids of each side.

    Rows are counted per distinct value first, so no list of row pairs is ever produced.
    """
    counts = df.groupBy(F.col(value).alias("low_value")).agg(
        F.count(F.lit(1)).alias("low_rows"), F.min(id_col).alias("low_first"))
    # a value that is half the target pairs with itself: its second-lowest id is needed too
    halves = df.where(F.col(value) * 2 == target).select(F.col(value).alias("low_value"), id_col)
    second = halves.join(counts.select("low_value", "low_first"), "low_value").where(
        F.col(id_col) > F.col("low_first")).groupBy("low_value").agg(F.min(id_col).alias("low_second"))
    counts = counts.join(second, "low_value", "left")
    partner = counts.select(
        (F.lit(target) - F.col("low_value")).alias("low_value"), F.col("low_value").alias("high_value"),
        F.col("low_rows").alias("high_rows"), F.col("low_first").alias("high_first"))
    same = F.col("low_value") == F.col("high_value")
    pairs = counts.join(partner, "low_value").where("low_value <= high_value")
    return pairs.select(
        "low_value", "high_value",
        F.when(same, F.floor(F.col("low_rows") * (F.col("low_rows") - 1) / 2))
        .otherwise(F.col("low_rows") * F.col("high_rows")).alias("row_pairs"),
        F.col("low_first").alias("low_id"),
        F.when(same, F.col("low_second")).otherwise(F.col("high_first")).alias("high_id"),
    ).where("row_pairs > 0")


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First n rows per key; the limit is applied inside each task before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(
        F.col("_rn") <= n).drop("_rn")
