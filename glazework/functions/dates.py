"""Date expressions (E-11 … E-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glazework import constants as K
from glazework.functions.text import trim_ws


def _two_digit_year_pivot(d: Column) -> Column:
    # Spark reads 'yy' as 2000..2099; years from the pivot on belong to the 1900s.
    return F.when(F.year(d) >= K.TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)


def parse_repair_date(raw: Column) -> Column:
    """E-11: ``dd-Mon-yy`` first; else ``m/d/Y`` when the 2nd '/' part is > 12, else ``d/m/Y``.

    Day-first wins whenever the second part is a valid month, so US dates with
    a day ≤ 12 are read day-first, as modelled. White space around the date is ignored. A year outside 1…9999 (the
    slash formats read the year as written) is no date. Unparsable input gives NULL
    (never an error): a missing second part or a non-numeric one falls through
    to the day-first parse, which then fails softly.
    """
    raw = trim_ws(raw)
    # A format can only match when its separator is present; checking first
    # avoids a failed (exception-raising) parse attempt on most rows. The
    # two-digit year of the dash format always lands in 1969..2068; the slash
    # formats read the year as written, so its range is checked up front.
    dash = F.when(raw.contains("-"), _two_digit_year_pivot(F.try_to_date(raw, K.DATE_FORMAT_DAY_MON_YY[1])))
    # text between the first and the second '/' (to the end when there is one)
    second = F.substring_index(F.substring_index(raw, "/", 2), "/", -1).try_cast("int")
    year = F.substring_index(raw, "/", -1).try_cast("int")
    slash = F.when(
        raw.contains("/") & year.between(K.DATE_MIN_YEAR, K.DATE_MAX_YEAR),
        F.when(second > 12, F.try_to_date(raw, K.DATE_FORMAT_US[1])).otherwise(
            F.try_to_date(raw, K.DATE_FORMAT_UK[1])
        ),
    )
    return F.coalesce(dash, slash)


def date_key(d: Column) -> Column:
    """E-12: yyyymmdd as a bigint (arithmetic, no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def month_name(d: Column) -> Column:
    """E-14: full English month name."""
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    """E-14: full English day name."""
    return F.date_format(d, "EEEE")


def day_of_week(d: Column) -> Column:
    """E-13: Sunday = 1 … Saturday = 7."""
    return F.dayofweek(d).cast("bigint")


def is_weekend(d: Column) -> Column:
    """E-15: Saturday or Sunday."""
    return F.dayofweek(d).isin(1, 7)
