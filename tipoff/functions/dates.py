"""Dates and seasons, as column expressions and as checks on scalar arguments."""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date input, request date format, and the season window.
ISO_DATE = "yyyy-M-d"
API_DATE = "yyyyMMdd"
SEASON_FIRST_MONTH, SEASON_FIRST_DAY = 11, 1
SEASON_LAST_MONTH, SEASON_LAST_DAY = 4, 30


# --- column expressions -------------------------------------------------------------


def iso_date(text: Column | str) -> Column:
    """Text as a date; null when it is not one. Single-digit months and days are accepted."""
    return F.try_to_date(text, ISO_DATE)


def api_date(day: Column | str) -> Column:
    """The request form of a date, ``YYYYMMDD``."""
    return F.date_format(day, API_DATE)


def partition_year(day: Column | str) -> Column:
    return F.date_format(day, "yyyy")


def partition_month(day: Column | str) -> Column:
    return F.date_format(day, "MM")


def season_label(end_year: Column) -> Column:
    """``2023`` as ``2022-23``."""
    start = (end_year - 1).cast("string")
    return F.concat(start, F.lit("-"), F.lpad((end_year % 100).cast("string"), 2, "0"))


def rolling_season_year(day: Column | str) -> Column:
    """The year a season ends in, for schedules that run through the whole year."""
    return F.year(day) + F.when(F.month(day) >= SEASON_FIRST_MONTH, 1).otherwise(0)


def season_year(day: Column | str) -> Column:
    """As :func:`rolling_season_year`, but null between seasons (May to October)."""
    in_season = (F.month(day) >= SEASON_FIRST_MONTH) | (F.month(day) <= SEASON_LAST_MONTH)
    return F.when(in_season, rolling_season_year(day))


def season_id(day: Column | str) -> Column:
    return season_label(season_year(day))


def season_start(end_year: Column) -> Column:
    return F.make_date(end_year - 1, F.lit(SEASON_FIRST_MONTH), F.lit(SEASON_FIRST_DAY))


def season_end(end_year: Column) -> Column:
    return F.make_date(end_year, F.lit(SEASON_LAST_MONTH), F.lit(SEASON_LAST_DAY))


# --- scalar arguments ---------------------------------------------------------------


def parse_date(text: str | date) -> date:
    if isinstance(text, date):
        return text
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError) as err:
        raise ValueError(f"{text!r} is not a date of the form 2019-12-30") from err


def check_range(start: str | date, end: str | date) -> tuple[date, date]:
    first, last = parse_date(start), parse_date(end)
    if last < first:
        raise ValueError(f"the first day {start} lies after {end}")
    return first, last


def season_window(season: str) -> tuple[date, date]:
    """``2022-23`` as its first and last day. The suffix must be the next year's."""
    match = re.fullmatch(r"(\d{4})-(\d{2})", season or "")
    if match is None or int(match[2]) != (int(match[1]) + 1) % 100:
        raise ValueError(f"{season!r} is not a season of the form 2014-15")
    start = int(match[1])
    return (
        date(start, SEASON_FIRST_MONTH, SEASON_FIRST_DAY),
        date(start + 1, SEASON_LAST_MONTH, SEASON_LAST_DAY),
    )


def today(as_of: str | date | None = None) -> date:
    """The reference day: ``as_of`` when given, else the current day in UTC."""
    return parse_date(as_of) if as_of else datetime.now(tz=UTC).date()


def yesterday(as_of: str | date | None = None) -> date:
    return today(as_of) - timedelta(days=1)
