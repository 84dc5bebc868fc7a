"""Date and time expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The relative-time words a listing page uses ("N minut temu", "wczoraj", ...).
YESTERDAY = "wczoraj"
UNIT_SECONDS = {"minut": 60, "godzin": 3600, "dni": 86400}

# First month of a season.
SEASON_START_MONTH = 7


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shift_months(date: Column | str, months: int) -> Column:
    """Add months; the last day of a month always lands on the last day of the target month."""
    d = _col(date)
    moved = F.add_months(d, months)
    return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)


def frac_days(later: Column | str, earlier: Column | str) -> Column:
    """Difference of two instants in days, with the fraction."""
    def seconds(c):
        return F.unix_micros(_col(c).cast("timestamp")) / F.lit(1_000_000)

    return (seconds(later) - seconds(earlier)) / 86400


def quarter_end(date: Column | str) -> Column:
    return F.last_day(F.add_months(F.trunc(_col(date), "quarter"), 2))


def season(date: Column | str) -> Column:
    """Season a date belongs to: its year from July on, the year before until June."""
    d = _col(date)
    return F.year(d) - (F.month(d) < SEASON_START_MONTH).cast("int")


def decade(date: Column | str) -> Column:
    return (F.floor(F.year(_col(date)) / 10) * 10).cast("int")


def age_now(age: Column | str, season_col: Column | str, year: int) -> Column:
    """Roll an age recorded in a season forward to a given year."""
    return _col(age) + (F.lit(year) - _col(season_col))


def window_date(season_col: Column, month: Column, day: Column) -> Column:
    """Opening date of a transfer window in a season; months before July fall in the next year."""
    return F.make_date(season_col + (month < SEASON_START_MONTH).cast("int"), month, day)


def in_year(date: str, year: int) -> Column:
    """Is a date in a year? A range of dates, which reaches the scan, where a function of the date would not."""
    day = lambda y: F.lit(f"{y}-01-01").cast("date")
    return (F.col(date) >= day(year)) & (F.col(date) < day(year + 1))


def _shape(pattern: str) -> str | None:
    """Regular expression for texts a numeric date pattern can parse; None for patterns with names in them."""
    shape = ""
    for run in re.findall(r"([A-Za-z])(\1*)|(.)", pattern):
        if run[2]:
            shape += re.escape(run[2])
        elif run[0] in "yMdHms":
            width = 1 + len(run[1])
            shape += r"\d+" if run[0] == "y" and width == 1 else r"\d{1,2}" if width == 1 else rf"\d{{{width}}}"
        else:
            return None
    return f"^{shape}$"


def try_date(text: Column | str, *patterns: str) -> Column:
    """First pattern that parses, else null.

    A pattern is tried only on text of its shape: a failed parse costs an exception per row.
    """
    t = _col(text)

    def parsed(pattern):
        shape = _shape(pattern)
        date = F.try_to_timestamp(t, F.lit(pattern)).cast("date")
        return F.when(t.rlike(shape), date) if shape else date

    return F.coalesce(*[parsed(p) for p in patterns])


def relative_time(text: Column | str, anchor: Column) -> Column:
    """Resolve "N minutes/hours/days ago" against a fixed anchor; unknown wording gives null."""
    found = rf"([0-9]+)\s+({'|'.join(UNIT_SECONDS)})"
    unit = F.regexp_extract(_col(text), found, 2)
    # a failed cast costs an exception per row, so "no match" becomes null before it
    amount = F.nullif(F.regexp_extract(_col(text), found, 1), F.lit("")).try_cast("decimal(18,0)")
    seconds = F.coalesce(*[F.when(unit == name, amount * size) for name, size in UNIT_SECONDS.items()],
                         F.when(_col(text).contains(YESTERDAY), F.lit(UNIT_SECONDS["dni"])))
    zero = F.lit(0)
    return anchor - F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
