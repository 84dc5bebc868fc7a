"""Change capture, validity history and mutation by rewriting, for plain parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablework.functions.dates import window_date
from tablework.operators.aggs import first_per_key
from tablework.operators.ordered import positions, shifted
from tablework.sources.buckets import BucketTable
from tablework.sources.landed import latest_per
from tablework.sources.tables import stage


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key, nulls included; new keys are added.

    Both sides hold a key once. A presence flag tells a null value from a missing row.
    """
    columns = target.columns
    fresh = source.select(*columns).withColumn("_new", F.lit(True)).alias("s")
    joined = target.alias("t").join(fresh, keys, "full")
    values = [c for c in columns if c not in keys]
    picked = {c: F.when(F.col("_new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in values}
    return joined.select(*[picked.get(c, F.col(c)) for c in columns])


def upsert_table(table: BucketTable, source: DataFrame, keys: list[str]) -> int:
    """``upsert`` into a stored table: only the buckets of the source's keys are read and written."""
    return table.rewrite(source, lambda rows: upsert(rows, source, keys))


def versions(changes: DataFrame, keys: list[str], value: str, since: str, written: list[str]) -> DataFrame:
    """Validity intervals from change rows in any order.

    The last write of a (key, start) wins, and each version ends the day before the next start. With
    dates as starts a key then has at most one row per calendar day; other starts are measured.
    """
    last = latest_per(changes.select(*keys, since, value, *written), [*keys, since], written).drop(*written)
    daily = dict(last.dtypes)[since] == "date"
    led = shifted(last, keys, [since], {"_next": (F.col(since), -1)}, bounded=daily)
    return led.select(*keys, value, F.col(since).alias("valid_since"), F.date_sub("_next", 1).alias("valid_till"))


def scd2_apply(history: DataFrame, old: DataFrame, new: DataFrame, key: str, attrs: list[str], as_of: Column) -> DataFrame:
    """Apply the difference of two snapshots to a history with ``valid_since`` and ``valid_till``.

    Changed keys: close the open row, add the new one. New keys: add. Vanished keys: close.
    """
    before = old.select(F.col(key), F.struct(*attrs).alias("_old"))
    after = new.select(F.col(key), F.struct(*attrs).alias("_new"))
    changed = before.join(after, key, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    closing = changed.where("_old IS NOT NULL").select(F.col(key).alias("_closed"))
    is_open = F.col("valid_till").isNull()
    kept = history.join(closing, (F.col(key) == F.col("_closed")) & is_open, "left").withColumn(
        "valid_till", F.when(F.col("_closed").isNotNull(), as_of).otherwise(F.col("valid_till"))).drop("_closed")
    added = changed.where("_new IS NOT NULL").select(
        key, "_new.*", as_of.alias("valid_since"), F.lit(None).cast("date").alias("valid_till"))
    return kept.select(key, *attrs, "valid_since", "valid_till").unionByName(added)


def scd2_apply_table(history: BucketTable, old: DataFrame, new: DataFrame, key: str, attrs: list[str], as_of: Column) -> int:
    """``scd2_apply`` to a stored history in buckets of ``key``: only those with a difference are read and written."""
    before = old.select(F.col(key), F.struct(*attrs).alias("_old"))
    after = new.select(F.col(key), F.struct(*attrs).alias("_new"))
    keys = before.join(after, key, "full").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(key)
    return history.rewrite(keys, lambda rows: scd2_apply(rows, old, new, key, attrs, as_of))


def snapshot(df: DataFrame, root: str, name: str, as_of: str) -> DataFrame:
    """Keep the current rows as the ``snapshot=YYYY-MM`` partition of their history."""
    return stage(df, root, name, snapshot=as_of[:7])


def assign_keys(stored: DataFrame, fresh: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Give rows without a key the numbers after the highest stored one, in the given order."""
    highest = stored.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    return positions(fresh, [], order, "_pos").withColumn(key, highest + F.col("_pos") + 1).drop("_pos")


def update_column(df: DataFrame, condition: Column, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def latest_membership(squads: DataFrame, transfers: DataFrame, player: str, team: str, date: str, tie: str,
                      order: list[str]) -> DataFrame:
    """Players listed with several teams get the team of their latest transfer; then one row per (player, team)."""
    several = squads.groupBy(player).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    latest = transfers.groupBy(player).agg(F.max_by(team, F.struct(date, tie)).alias("_latest"))
    decided = several.join(latest, player).select(player, "_latest")
    corrected = squads.join(decided, player, "left").withColumn(team, F.coalesce("_latest", team)).drop("_latest")
    return first_per_key(corrected, [player, team], order)


def membership_start(members: DataFrame, transfers: DataFrame, windows: DataFrame) -> DataFrame:
    """Start date of each (player, team, season): the earliest transfer date not used yet, else the window opening.

    The n-th season of a player in a team takes the n-th distinct transfer date into it. Players with
    more than one team in the season default to the winter window, others to the summer window. Seasons
    and dates per (player, team) are distinct, so their number is bounded by the calendar.
    """
    pair = ["player", "team"]
    per_season = members.groupBy("player", "season").agg(F.countDistinct("team").alias("teams"))
    nth = positions(members.select(*pair, "season").distinct(), pair, ["season"], "_n", bounded=True)
    dated = positions(transfers.select(*pair, "date").distinct(), pair, ["date"], "_n", bounded=True)
    default = F.when(
        F.col("teams") > 1, window_date(F.col("season"), F.col("winter_month"), F.col("winter_day"))
    ).otherwise(window_date(F.col("season"), F.col("summer_month"), F.col("summer_day")))
    return (
        nth.join(dated, [*pair, "_n"], "left")
        .join(per_season, ["player", "season"])
        .join(windows, "team", "left")
        .select(*pair, "season", F.coalesce("date", default).alias("valid_since"))
    )


def fill_from_candidates(df: DataFrame, candidates: DataFrame, keys: list[str], values: list[str], rank: str,
                         tries: int = 2) -> DataFrame:
    """Fill null values from one candidate row: the first by rank within the allowed tries.

    All values come from that row, so a result never mixes two of them; what it lacks stays null.
    """
    usable = candidates.where(F.col(rank) <= tries)
    best = usable.groupBy(*keys).agg(F.min(F.struct(rank, *values)).alias("_best"))
    filled = df.join(best, keys, "left").withColumns({v: F.coalesce(v, f"_best.{v}") for v in values})
    return filled.select(*df.columns)
