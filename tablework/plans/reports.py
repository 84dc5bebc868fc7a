"""End-to-end reports composed from the operators."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablework.functions.dates import age_now, decade, season, try_date
from tablework.functions.numbers import leverage, pct_change, safe_div
from tablework.functions.text import money
from tablework.operators.aggs import first_event, keep_last
from tablework.operators.filters import split_complete
from tablework.operators.history import fill_from_candidates
from tablework.operators.joins import asof_join, new_rows, top_rows, with_group_value, year_over_year
from tablework.operators.ordered import rolling, shifted
from tablework.operators.reshape import drop_last_groups, stack
from tablework.operators.windows import line_ids
from tablework.sources.tables import staged

# Thresholds of the early-warning rules.
LOW_CURRENT_RATIO = 0.5
LOW_QUICK_RATIO = 0.4
LOW_DEBT_COVER = 1
HIGH_SHARED_DEBT = 100
SHARED_DEBT_LIMIT = 1_000_000
INCOME_DROP = -20
LEVERAGE_RISE = 1
ROS_DROP = -3
ROE_DROP = -2
ROLLING_REPORTS = 7
QUICK_HITS = 6
CURRENT_HITS = 3
SHARED_HITS = 6


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def rated_statements(statements: DataFrame, before: datetime.date | None = None) -> DataFrame:
    """Statements (firm, date, k1, cr, qr, wod, woz, ros, income, profit, equity) with ratios, the changes
    against the same quarter a year earlier, and the single-statement flags."""
    rated = statements.withColumns({"leverage": leverage("k1"), "roe": safe_div("profit", "equity")})
    year = year_over_year(rated, ["firm"], "date", ["income", "leverage", "ros", "roe"])
    current = year.where(F.month("date").isin(3, 6, 9, 12))
    if before:
        current = current.where(F.col("date") < F.lit(before))
    return current.withColumns({
        "leverage_change": F.when(F.col("last_leverage") >= 0, F.col("leverage") - F.col("last_leverage")),
        "ros_change": F.col("ros") - F.col("last_ros"),
        "roe_change": F.col("roe") - F.col("last_roe"),
        "income_change": pct_change("income", "last_income"),
        "low_cr": _flag((F.col("cr") < LOW_CURRENT_RATIO) & (F.col("wod") < LOW_DEBT_COVER)),
        "low_qr": _flag((F.col("qr") < LOW_QUICK_RATIO) & (F.col("wod") < LOW_DEBT_COVER)),
        "lost_equity": _flag(F.col("k1") < 0),
        "shared_debt": _flag(F.col("woz") > HIGH_SHARED_DEBT),
    })


def monitored(statements: DataFrame, exposures: DataFrame, before: datetime.date | None = None) -> DataFrame:
    """Exposure per firm and report date with the latest statement on or before it.

    After the aggregation a firm has at most one row per report date and one per quarter, so the as-of
    window is bounded by the calendar.
    """
    totals = exposures.groupBy("firm", "report_date").agg(
        F.sum("exposure").alias("exposure"), F.max("bucket").alias("bucket"))
    rated = rated_statements(statements, before)
    found = asof_join(totals, rated, ["firm"], "report_date", "date", bounded=True)
    return found.where(F.col("date").isNotNull())


def _final(df: DataFrame, report_date: datetime.date | None, min_year: int, min_exposure: float, bucket: int) -> DataFrame:
    kept = df.where((F.year("date") >= min_year) & (F.col("exposure") > min_exposure) & (F.col("bucket") == bucket))
    return kept.where(F.col("report_date") == F.lit(report_date)) if report_date else kept


def early_warning(matched: DataFrame, *, report_date: datetime.date | None, min_year: int, min_exposure: float,
                  bucket: int) -> DataFrame:
    """Firms with full statements for which at least one warning flag is raised."""
    own = matched.where("woz IS NULL")
    rolled = rolling(own, ["firm"], ["report_date"], ROLLING_REPORTS, {
        "qr_hits": ("sum", F.col("low_qr")), "cr_hits": ("sum", F.col("low_cr"))}, bounded=True)
    flagged = rolled.withColumns({
        "lasting_qr": _flag(F.col("qr_hits") >= QUICK_HITS),
        "lasting_cr": _flag(F.col("cr_hits") >= CURRENT_HITS),
        "income_and_leverage": _flag((F.col("income_change") <= INCOME_DROP) & (F.col("leverage_change") >= LEVERAGE_RISE)),
        "ros_and_roe": _flag((F.col("ros_change") <= ROS_DROP) & (F.col("roe_change") <= ROE_DROP)),
    })
    flags = ["low_cr", "low_qr", "lost_equity", "lasting_qr", "lasting_cr", "income_and_leverage", "ros_and_roe"]
    raised = reduce(lambda a, b: a | b, [F.col(f) == 1 for f in flags])
    return _final(flagged.where(raised), report_date, min_year, min_exposure, bucket).select(
        "report_date", "firm", "date", "bucket", "exposure", *flags, "k1", "qr", "cr", "wod", "ros", "last_ros",
        "ros_change", "roe", "last_roe", "roe_change", "income", "last_income", "income_change", "leverage",
        "last_leverage", "leverage_change", "last_date")


def early_warning_shared(matched: DataFrame, *, report_date: datetime.date | None, min_year: int,
                         min_exposure: float, bucket: int) -> DataFrame:
    """Firms with the shared-debt ratio for which it was too high in most of the last reports."""
    shared = matched.where(F.col("woz").isNotNull() & (F.abs("woz") < SHARED_DEBT_LIMIT))
    rolled = rolling(shared, ["firm"], ["report_date"], ROLLING_REPORTS, {"hits": ("sum", F.col("shared_debt"))}, bounded=True)
    lasting = rolled.where(F.col("hits") >= SHARED_HITS)
    return _final(lasting, report_date, min_year, min_exposure, bucket).select(
        "report_date", "firm", "date", "bucket", "exposure", "hits")


def premises(statements: DataFrame, exposures: DataFrame, report_date: datetime.date, statement_date: datetime.date) -> DataFrame:
    """Changes against the previous statement with two premise flags and exposure totals of one report date."""
    totals = exposures.where(F.col("report_date") == F.lit(report_date)).groupBy("firm").agg(
        F.sum("exposure").alias("exposure"), F.max("bucket").alias("bucket"))
    rated = statements.withColumns({"leverage": leverage("k1"), "roe": safe_div("profit", "equity")})
    values = ["income", "roe", "ros", "leverage"]
    lagged = shifted(rated, ["firm"], ["date"], {f"last_{v}": (F.col(v), 1) for v in values}, bounded=True)
    income = F.coalesce(safe_div(F.col("income") - F.col("last_income"), "last_income"), F.lit(0.0)) * 100
    lever = F.when(F.col("last_leverage") >= 0, F.col("leverage") - F.col("last_leverage"))
    changed = lagged.withColumns({
        "income_change": income, "leverage_change": lever,
        "ros_change": F.col("ros") - F.col("last_ros"), "roe_change": F.col("roe") - F.col("last_roe")})
    # the date filter stays above the lag, whose input is the statement before
    return changed.where(F.col("date") == F.lit(statement_date)).join(totals, "firm", "left").select(
        "firm", "date", "exposure", "bucket",
        F.when((F.col("income_change") <= INCOME_DROP) & (F.col("leverage_change") >= LEVERAGE_RISE), 1).alias("leverage_premise"),
        F.when((F.col("ros_change") <= ROS_DROP) & (F.col("roe_change") <= ROE_DROP), 2).alias("income_premise"),
        *[F.round(c, 2).alias(c) for c in ("income_change", "leverage_change", "ros_change", "roe_change")])


def default_profile(rows: DataFrame) -> DataFrame:
    """Per account: first default dates, days until them, and the state on the last report.

    Input: account, date, capital, defaulted (0/1), overdue (0/1), lost (T/N).
    """
    lost = (F.col("lost") == "T").cast("int")
    day = F.col("date")
    per_account = rows.groupBy("account").agg(
        first_event(F.col("defaulted"), day).alias("default_date"),
        first_event(F.col("overdue"), day).alias("overdue_date"),
        first_event(lost, day).alias("loss_date"),
        F.min(day).alias("first_date"), F.max(day).alias("last_date"),
        keep_last(F.col("capital"), day, "max").alias("capital_now"),
        keep_last(F.col("lost"), day, "max").alias("lost_now"),
        keep_last(F.col("defaulted"), day, "min").alias("defaulted_now"))
    return per_account.withColumns({
        f"days_to_{e}": F.datediff(f"{e}_date", "first_date") for e in ("default", "overdue", "loss")})


def deviation_share(details: DataFrame, applications: DataFrame, first_seen: DataFrame,
                    start: datetime.date, end: datetime.date) -> DataFrame:
    """Deviations with risk on accounts first seen in the period, as a share of the accounts applied for and
    started in it whose audit was less than a day after they were first seen.

    first_seen: account, first_date.
    """
    risky = details.join(first_seen, "account").where(
        F.col("first_date").between(F.lit(start), F.lit(end)) & (F.col("deviations") > 0))
    first = top_rows(applications, ["account"], [F.col("audit").asc_nulls_last(), F.col("started").desc_nulls_last()])
    days = (F.unix_date(F.to_date("audit")) - F.unix_date("first_date")).cast("double")
    started = first.join(first_seen, "account").where(
        (F.col("started") == "T") & (days < 1) & (F.col("audit") >= F.lit(start))
        & (F.col("audit") < F.lit(end + datetime.timedelta(days=1))))
    above = risky.agg(F.count(F.lit(1)).alias("n"))
    below = started.agg(F.count("account").alias("m"))
    return above.select(F.col("n").alias("deviations"), below.scalar().alias("started")).withColumn(
        "share", safe_div("deviations", "started"))


def leverage_report(statements: DataFrame, exposures: DataFrame, profile: DataFrame) -> DataFrame:
    """Leverage on the statement date with the exposure of that date and the default profile of the account."""
    joined = statements.join(exposures, (statements.firm == exposures.owner) & (F.col("date") == F.col("report_date")))
    return joined.join(profile, "account").select(
        "firm", "date", "k1", "account", "exposure", "bucket", "days_to_default", "days_to_overdue", "days_to_loss",
        (F.col("k1") / 100).alias("equity_share"), leverage("k1").alias("leverage"),
    ).orderBy(F.col("firm").asc_nulls_last(), F.col("date").asc_nulls_last())


def invoice_lines(facts: DataFrame, units: DataFrame, charges: DataFrame, period: str, without: str) -> DataFrame:
    """Invoice lines of a period: approved deliveries, plus filler lines up to the minimum volume.

    The unit ``without`` is not invoiced.

    facts: unit, quantity, computer, mail, application, status, period, line; units: unit, unit_name,
    service, tower, pricing; charges: unit, arc_quantity, delivered_quantity, arc_price, base_price.
    """
    approved = facts.where(F.col("status").isin("approved", "invoiced") & (F.col("period") == period))
    delivered = approved.groupBy("unit").agg(F.sum("quantity").alias("how_many"))
    lacking = F.coalesce("arc_quantity", "delivered_quantity") - F.coalesce("how_many", F.lit(0.0))
    filler = charges.join(delivered, "unit", "left").select("unit", lacking.alias("quantity")).where("quantity > 0")
    lines = stack(approved.select("unit", "quantity", "computer", "mail", "application", "line"), filler)
    # units and charges hold one row per resource unit
    priced = lines.join(units, "unit").join(charges, "unit", "left").where(F.col("unit") != without)
    price = F.when(F.col("pricing") == "A", F.round("arc_price", 2)).when(
        F.col("pricing").isin("U", "F"), F.round("base_price", 2))
    named = priced.withColumn(
        "lifetime_id",
        F.when(F.col("pricing") == "A", F.concat_ws(":", "unit_name", F.coalesce("computer", "service")))
        .when(F.col("pricing") == "U", F.concat_ws(":", "unit_name", F.coalesce("application", F.lit("Minimum Volume"))))
        .otherwise(F.concat("unit_name", F.lit(":"), "mail")))
    numbered = line_ids(named, [F.col("unit").asc_nulls_last(), F.col("line").asc_nulls_last()], F.lit(period), "line_id")
    return numbered.select(
        "line_id", F.substring(F.lit(period), 0, 4).alias("report_year"), F.substring(F.lit(period), 6, 2).alias("report_month"),
        "unit", "tower", "service", "lifetime_id", "quantity", price.alias("unit_price"),
        F.round(price * F.col("quantity"), 2).alias("amount"))


def invoice_totals(units: DataFrame, charges: DataFrame, past: DataFrame, baselines: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """One row per resource unit: current against previous volume, and percent of the baseline."""
    invoiced = F.when(F.col("pricing") == "A", F.col("arc_quantity")).when(
        F.col("pricing").isin("U", "F"), F.col("delivered_quantity"))
    previous = F.coalesce("past_arc", "past_delivered")
    joined = units.join(charges, "unit", "left").join(past, "unit", "left").join(baselines, "unit", "left")
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in prefixes.items())
    return joined.select(
        "unit", "tower", F.expr(f"decode(unit_name, {pairs})").alias("prefix"),
        F.round(F.coalesce("base_price", "arc_price"), 2).alias("unit_price"),
        F.coalesce("baseline", F.lit(0.0)).alias("baseline"),
        F.coalesce(previous, F.lit(0.0)).alias("previous_volume"),
        F.coalesce(invoiced, F.lit(0.0)).alias("invoiced_volume"),
        F.coalesce(invoiced - previous, F.lit(0.0)).alias("delta_volume"),
        F.round(F.coalesce(safe_div(F.lit(100.0), "baseline") * invoiced, F.lit(0.0)), 2).alias("pct_baseline"))


def main_per_group(df: DataFrame, group: str, key: str, exclude: str) -> DataFrame:
    """The row with the lowest id of every group outside the excluded one."""
    kept = df.where(F.col(group) != exclude)
    return kept.join(kept.groupBy(group).agg(F.min(key).alias(key)), [group, key], "left_semi")


def player_master(transfers: DataFrame, squads: DataFrame, seasons: DataFrame, year: int) -> DataFrame:
    """Latest transfer of every player with squad attributes; incomplete players are filled from earlier seasons.

    transfers: player, team, date (text); squads: player, squad_team, first_name, age, nationality, season;
    seasons: player, season, first_name, age, nationality.
    """
    latest = with_group_value(transfers, ["player"], F.max("date").alias("_d")).where("date = _d").drop("_d").distinct()
    # both halves come from the same rows, so those are written once
    complete, lacking = split_complete(staged(latest.join(squads, "player", "left"), "players"))
    lacking = lacking.withColumn("date", try_date("date", "yyyy-MM-dd")).na.drop(subset=["date"])
    lacking = lacking.withColumn("season", season("date"))
    attributes = ["first_name", "age", "nationality"]
    # a season's attributes are the first try for that season and the second try for the one after
    tries = F.explode(F.array(F.lit(1), F.lit(2))).alias("rank")
    candidates = seasons.select("*", tries).select(
        "player", (F.col("season") + F.col("rank") - 1).alias("season"), "rank", "first_name",
        age_now("age", "season", year).alias("age"), "nationality")
    filled = fill_from_candidates(lacking, candidates, ["player", "season"], attributes, "rank", tries=2)
    counted = with_group_value(filled, ["team", "season"], F.count(F.lit(1)).alias("count"))
    return stack(complete.withColumn("date", F.to_date("date")), counted)


def ingest_listings(parsed: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored listings plus the newly seen ones."""
    return stack(stored, new_rows(parsed, stored, ["listing_id"]).select(*stored.columns))


def film_facts(films: DataFrame) -> DataFrame:
    """Money text to numbers, date text to dates, decade, and a loss flag."""
    return films.select(
        "title", try_date("released", "yyyy-MM-dd", "M/d/yyyy").alias("released"),
        *[money(c).alias(c) for c in ("budget", "worldwide", "domestic")]
    ).withColumns({"decade": decade("released"), "loss": F.col("budget") > F.col("worldwide")})


def film_profitability(films: DataFrame, until_year: int) -> DataFrame:
    """Per era and decade: films, share that lost money, zero-gross films, mean and highest budget."""
    era = F.when(F.year("released") <= until_year, "old").otherwise("new")
    return film_facts(films).groupBy(era.alias("era"), "decade").agg(
        F.count(F.lit(1)).alias("films"), F.round(F.avg(F.col("loss").cast("double")), 6).alias("loss_share"),
        F.count_if(F.col("worldwide") == 0).alias("zero_worldwide"),
        F.count_if((F.col("domestic") == 0) & (F.col("worldwide") > 0)).alias("international_only"),
        F.round(F.avg("budget"), 2).alias("mean_budget"), F.max("budget").alias("top_budget"))


def release_trend(sets: DataFrame, partial_years: int) -> DataFrame:
    """Sets, distinct themes and mean number of parts per year, without the last partial years."""
    per_year = sets.groupBy("year").agg(
        F.count(F.lit(1)).alias("sets"), F.countDistinct("theme").alias("themes"), F.avg("parts").alias("mean_parts"))
    # a row per year, read twice below
    return drop_last_groups(staged(per_year, "per_year"), "year", partial_years)
