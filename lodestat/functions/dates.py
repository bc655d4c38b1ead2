"""Date parts, durations and repairs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: English month abbreviations
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_end(text: Column, pattern: str = "MM/yyyy") -> Column:
    """Last day of a month given as text."""
    return F.last_day(F.to_date(text, pattern))


def repair_month(text: Column) -> Column:
    """First day of the month of "Mon-yy" or "y-Mon"; years 00-19 are 20xx, the rest 19xx; else null."""
    name = F.lower(F.regexp_extract(text, r"([A-Za-z]{3})", 1))
    number = F.regexp_extract(text, r"(\d{1,2})", 1).try_cast("int")
    table = F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(i + 1))])
    year = number + F.when(number < 20, 2000).otherwise(1900)
    fits = text.rlike(r"^[A-Za-z]{3}-\d{2}$") | text.rlike(r"^\d{1,2}-[A-Za-z]{3}$")
    return F.when(fits & table[name].isNotNull(), F.make_date(year, table[name], F.lit(1)))


def parts(ts: Column) -> dict[str, Column]:
    """Calendar parts; the week starts on Monday = 1."""
    return {
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "weekday": F.weekday(ts) + 1,
        "hour": F.hour(ts),
        "iso_week": F.weekofyear(ts),
    }


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two times, cut toward zero (may be negative)."""
    seconds = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    days = seconds / F.lit(86_400_000_000)
    return F.when(days >= 0, F.floor(days)).otherwise(F.ceil(days)).cast("int")


def cyclic(value: Column, period: float, name: str) -> dict[str, Column]:
    angle = value * (2 * math.pi / period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
