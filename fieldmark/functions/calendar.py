"""Calendar features.  Weekdays run from 1 = Sunday to 7 = Saturday."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours counted as business time and as morning.
BUSINESS_HOURS = (8, 18)
MORNING_HOURS = (5, 8)


def epoch_seconds(time: Column) -> Column:
    """Seconds since 1970 of a timestamp without time zone."""
    return F.unix_date(time.cast("date")).cast("bigint") * 86400 + (
        F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    )


def time_floor(time: Column, minutes: int) -> Column:
    """Start of the `minutes`-long slot counted from midnight; divides 1440."""
    if 1440 % minutes:
        raise ValueError("minutes must divide a day")
    into = F.pmod(F.hour(time) * 60 + F.minute(time), F.lit(minutes))
    return F.date_trunc("minute", time).cast("timestamp_ntz") - F.make_dt_interval(mins=into)


def hour_start(time: Column) -> Column:
    return F.date_trunc("hour", time).cast("timestamp_ntz")


def day_start(time: Column) -> Column:
    return time.cast("date").cast("timestamp_ntz")


def week_start(time: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", time).cast("timestamp_ntz")


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks crossed from start to end."""
    hours_s = F.unix_date(start.cast("date")) * 24 + F.hour(start)
    hours_e = F.unix_date(end.cast("date")) * 24 + F.hour(end)
    return hours_e - hours_s


def day_boundaries(start: Column, end: Column) -> Column:
    """Number of midnights crossed from start to end."""
    return F.datediff(end.cast("date"), start.cast("date"))


def day_hour_columns(time: Column) -> dict[str, Column]:
    """Hour, weekday, month and the weekend, business and morning flags."""
    hour, weekday = F.hour(time), F.dayofweek(time)
    return {
        "hourofday": hour,
        "dayinweek": weekday,
        "monofyear": F.month(time),
        "weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
        "businesstime": F.when(hour.between(*BUSINESS_HOURS), 1).otherwise(0),
        "ismorning": F.when(hour.between(*MORNING_HOURS), 1).otherwise(0),
    }


def week_of_year_sunday(day: Column) -> Column:
    """Week number 0..53 where weeks start on Sunday; days before it are week 0."""
    return F.floor((F.dayofyear(day) + 6 - (F.dayofweek(day) - 1)) / F.lit(7)).cast("int")


def week_columns(time: Column) -> dict[str, Column]:
    """Year, month, week of month, and week of year of the Sunday ending the week."""
    day = time.cast("date")
    sunday = F.date_add(day, F.pmod(F.lit(8) - F.dayofweek(day), F.lit(7)).cast("int"))
    return {
        "year": F.year(day),
        "month": F.month(day),
        "weekofmonth": F.ceil(F.dayofmonth(day) / F.lit(7)).cast("int"),
        "weekofyear": week_of_year_sunday(sunday),
    }


def _nth_weekday(year: Column, month: int, weekday: str, nth: int) -> Column:
    last_of_previous = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(last_of_previous, weekday), 7 * (nth - 1))


def _iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def _observed(holiday: Column, observed_on: Column) -> Column:
    """First day at or after the holiday that falls on the observation weekday."""
    ahead = F.pmod(observed_on - _iso_weekday(holiday), F.lit(7)).cast("int")
    return F.date_add(holiday, ahead)


def us_holidays(year: Column) -> dict[str, Column]:
    """Dates of the five retail holidays of a year."""
    thanksgiving = _nth_weekday(year, 11, "THU", 4)
    return {
        "us_new_year": F.make_date(year, F.lit(1), F.lit(1)),
        "us_labor_day": _nth_weekday(year, 9, "MON", 1),
        "us_thanksgiving": thanksgiving,
        "cyber_monday": F.date_add(thanksgiving, 4),
        "christmas": F.make_date(year, F.lit(12), F.lit(25)),
    }


def holiday_columns(time: Column) -> dict[str, Column]:
    """Flag the weekly observation that a holiday is moved to.

    Observations of one series fall on one weekday, so the weekday of the row
    is the observation weekday.  A holiday late in December may move into the
    next year, so the holidays of the previous year are looked at as well.
    No table of holidays is joined: a date is a function of its year.
    """
    day = time.cast("date")
    weekday = _iso_weekday(day)
    this_year, last_year = us_holidays(F.year(day)), us_holidays(F.year(day) - 1)
    return {
        name: F.when(
            (day == _observed(this_year[name], weekday)) | (day == _observed(last_year[name], weekday)), 1
        ).otherwise(0)
        for name in this_year
    }


def daily_fourier(day_number: Column, weekend: Column, orders: int = 2) -> dict[str, Column]:
    """Yearly trend and waves, apart for weekend and weekday rows."""
    out = {"linear_trend": day_number / F.lit(365.25)}
    for s in range(1, orders + 1):
        angle = day_number * F.lit(2 * math.pi * s / 365.25)
        for wave, value in (("cos", F.cos(angle)), ("sin", F.sin(angle))):
            out[f"we_{wave}{s}"] = value * weekend
            out[f"wd_{wave}{s}"] = value * (1 - weekend)
    return out


def season_fourier(position: Column, season: int = 52, orders: int = 4) -> dict[str, Column]:
    """Waves of the position within the season."""
    phase = F.pmod(position, F.lit(season))
    out = {}
    for s in range(1, orders + 1):
        angle = phase * F.lit(2 * math.pi * s / season)
        out[f"cos{s}"] = F.cos(angle)
        out[f"sin{s}"] = F.sin(angle)
    return out
