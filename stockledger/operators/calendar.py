"""Date dimension: one row per calendar day with week and year numbers.

The mart only needs ``d_date_sk, cal_dt, wk_num, yr_num, day_of_wk_num``
(0 = Sunday). The week numbering rule of the source's date table is not
stated, so two rules are offered:

* ``"sunday"``  - a week runs Sunday..Saturday and belongs to the year of its
  Sunday; weeks are numbered from that year's first Sunday. Every
  ``(wk_num, yr_num)`` has exactly one Sunday.
* ``"calendar_u"`` - ``strftime('%U')`` numbering inside the calendar year;
  days before the first Sunday are week 0, so weeks that straddle New Year
  are split and some ``(wk_num, yr_num)`` have no Sunday.
* ``"iso_calendar"`` - ISO week numbers beside the calendar year; a number can
  recur in one year (1 January and 31 December), so a week may have two Sundays.

A calendar has one row per day. Nothing caps its span and no join forces its
broadcast: Spark chooses from its size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEK_RULES = ("sunday", "calendar_u", "iso_calendar")


def date_attributes(days: DataFrame, week_rule: str = "sunday", day_col: str = "cal_dt") -> DataFrame:
    """Add the date-dimension columns to a frame of dates."""
    if week_rule not in WEEK_RULES:
        raise ValueError(f"week_rule must be one of {WEEK_RULES}")
    d = F.col(day_col)
    dow = F.dayofweek(d) - 1  # 0 = Sunday
    if week_rule == "sunday":
        sunday = F.date_sub(d, dow)
        yr = F.year(sunday)
        wk = F.floor((F.dayofyear(sunday) - 1) / 7) + 1
    elif week_rule == "iso_calendar":
        yr = F.year(d)
        wk = F.weekofyear(d)
    else:
        yr = F.year(d)
        wk = F.floor((F.dayofyear(d) + 6 - dow) / 7)
    return days.select(
        F.unix_date(d).cast("bigint").alias("d_date_sk"),
        d.alias("cal_dt"),
        wk.cast("int").alias("wk_num"),
        yr.cast("int").alias("yr_num"),
        dow.cast("int").alias("day_of_wk_num"),
    )


def calendar_between(bounds: DataFrame, week_rule: str = "sunday", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar from the Sunday on or before ``lo`` through ``hi``.

    ``bounds`` is a one-row frame (typically a global min/max aggregate); the
    plan stays lazy and the day rows are generated on an executor.
    """
    lo_d = F.to_date(F.col(lo))
    hi_d = F.to_date(F.col(hi))
    start = F.date_sub(lo_d, F.dayofweek(lo_d) - 1)
    days = (
        bounds.select(start.alias("_start"), hi_d.alias("_end"))
        .select(F.explode(F.sequence(F.col("_start"), F.col("_end"))).alias("cal_dt"))
    )
    return date_attributes(days, week_rule)


def calendar_spanning(df: DataFrame, date_col: str | Column, week_rule: str = "sunday") -> DataFrame:
    """Calendar covering every date in ``df[date_col]``."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    bounds = df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi"))
    return calendar_between(bounds, week_rule)


def sundays(date_dim: DataFrame) -> DataFrame:
    """``(d_date_sk, wk_num, yr_num)`` of the Sundays: the week's key day."""
    return date_dim.where(F.col("day_of_wk_num") == 0).select("d_date_sk", "wk_num", "yr_num")
