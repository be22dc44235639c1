"""Calendar expressions on a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def period_start(day: Column, period: str) -> Column:
    """First day of the day, ISO week or month that holds ``day``."""
    if period == "day":
        return day.cast("date")
    if period == "week":
        return week_start(day)
    if period == "month":
        return month_start(day)
    raise ValueError(f"unknown period: {period}")


def hours_between(later: Column, earlier: Column) -> Column:
    seconds = F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))
    return seconds / F.lit(3600.0)


def months_by_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed days divided by thirty."""
    seconds = F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))
    return F.floor(seconds / F.lit(86400.0)) / F.lit(30.0)


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a periodic calendar field."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def temporal_columns(day: Column) -> dict[str, Column]:
    """The calendar features of a date, keyed by feature name."""
    weekday = F.weekday(day)
    quarter_start = F.trunc(day, "quarter")
    month_sin, month_cos = cyclic(F.month(day), 12)
    dow_sin, dow_cos = cyclic(weekday, 7)
    doy_sin, doy_cos = cyclic(F.dayofyear(day), 365)
    return {
        "Year": F.year(day),
        "Month": F.month(day),
        "Day": F.dayofmonth(day),
        "DayOfWeek": weekday,
        "DayOfYear": F.dayofyear(day),
        "WeekOfYear": F.weekofyear(day),
        "Quarter": F.quarter(day),
        "IsWeekend": (weekday >= 5).cast("int"),
        "IsMonthStart": (F.dayofmonth(day) == 1).cast("int"),
        "IsMonthEnd": (F.last_day(day) == day).cast("int"),
        "IsQuarterStart": (quarter_start == day).cast("int"),
        "IsQuarterEnd": (F.date_sub(F.add_months(quarter_start, 3), 1) == day).cast("int"),
        "Month_sin": month_sin,
        "Month_cos": month_cos,
        "DayOfWeek_sin": dow_sin,
        "DayOfWeek_cos": dow_cos,
        "DayOfYear_sin": doy_sin,
        "DayOfYear_cos": doy_cos,
    }
