"""Column rules shared by all operators: calendar, status, urgency, staffing, rounding."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
STATUSES = ["operational", "maintenance_required", "faulty"]
SEASONS = ["monsoon", "summer", "winter"]
SPECIALIZATIONS = ["LED", "Sodium Vapor", "All"]
URBAN_CLASSES = ["urban", "suburban", "rural"]
ISSUE_TYPES = ["bulb_failure", "wiring", "pole_damage", "power_supply", "sensor_failure"]
URGENCIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
STATUS_COLORS = {
    "operational": "#2ecc71",
    "maintenance_required": "#f39c12",
    "faulty": "#e74c3c",
    "predicted_failure": "#ff6b6b",
}
URGENCY_COLORS = {"CRITICAL": "#c0392b", "HIGH": "#e67e22", "MEDIUM": "#f39c12", "LOW": "#95a5a6"}

AsOf = dt.date | str | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The reference day; today unless pinned."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def as_of_season(as_of: AsOf = None) -> Column:
    return season(as_of_date(as_of))


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding (half away from zero), returned as DOUBLE."""
    return F.round(value.cast("decimal(28,9)"), digits).cast("double")


def round_many(value: Column, digits: int) -> Column:
    """``round_half_up`` for very many rows: decimals decide only what lies near a half or is large."""
    scaled = value * float(10**digits)
    clear = (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-5) & (F.abs(scaled) < 1e9)
    return F.when(clear, F.floor(scaled + 0.5) / F.lit(float(10**digits))).otherwise(round_half_up(value, digits))


def round_int(value: Column) -> Column:
    return F.round(value.cast("decimal(28,9)"), 0).cast("bigint")


def ratio_pct(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    return round_half_up(
        F.lit(100).cast("decimal(18,0)") * part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)"),
        digits,
    )


def season(day: Column) -> Column:
    """June-September monsoon, March-May summer, every other month winter."""
    month = F.month(day)
    return (
        F.when(month.between(6, 9), F.lit("monsoon")).when(month.between(3, 5), F.lit("summer")).otherwise(F.lit("winter"))
    )


def age_months(start: Column, end: Column) -> Column:
    """Full calendar months between two dates; a month end is not special."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return months - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)


def age_day_part(start: Column, end: Column) -> Column:
    """Days left over after full months (0..30) between a timestamp and a later date's midnight."""
    day = F.to_date(start)
    borrow = F.when(F.hour(start) * 3600 + F.minute(start) * 60 + F.second(start) > 0, 1).otherwise(0)
    days = F.dayofmonth(end) - F.dayofmonth(day) - borrow
    return F.when(days < 0, days + F.dayofmonth(F.last_day(day))).otherwise(days)


def urgency(failure_date: Column, as_of: AsOf = None) -> Column:
    today = as_of_date(as_of)
    return (
        F.when(failure_date <= F.date_add(today, 7), F.lit("CRITICAL"))
        .when(failure_date <= F.date_add(today, 30), F.lit("HIGH"))
        .when(failure_date <= F.date_add(today, 90), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def request_status(resolved_at: Column) -> Column:
    return F.when(resolved_at.isNull(), F.lit("OPEN")).otherwise(F.lit("CLOSED"))


def elapsed_hours(start: Column, end: Column) -> Column:
    """Exact hours between two timestamps."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def hours_crossed(start: Column, end: Column) -> Column:
    """Number of clock-hour boundaries between two timestamps."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", start), F.date_trunc("hour", end))


def day_of_week(day: Column) -> Column:
    """Sunday = 0."""
    return F.dayofweek(day) - 1


def week_start(day: Column) -> Column:
    """Monday of the day's week."""
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def tier(value: Column, high: int, medium: int, labels: tuple[str, str, str] = ("HIGH", "MEDIUM", "LOW")) -> Column:
    return F.when(value >= high, F.lit(labels[0])).when(value >= medium, F.lit(labels[1])).otherwise(F.lit(labels[2]))


def urban_class(density: Column) -> Column:
    return F.when(density > 15000, F.lit("urban")).when(density > 5000, F.lit("suburban")).otherwise(F.lit("rural"))


def lookup(value: Column, table: dict[str, str]) -> Column:
    """Constant lookup table as a map literal."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.element_at(F.create_map(*pairs), value)


def map_url(lat: Column, lon: Column, prefix: str = "https://www.google.com/maps?q=") -> Column:
    """Map link, NULL when there is no location."""
    return F.concat(F.lit(prefix), lat.cast("string"), F.lit(","), lon.cast("string"))


def preview(text: Column, length: int) -> Column:
    """First characters plus an ellipsis, even for short text."""
    return F.concat(F.left(text, F.lit(length)), F.lit("..."))


def ilike_any(text: Column, patterns: list[str]) -> Column:
    """Case-insensitive LIKE against any pattern.

    Plain ``%word%`` patterns become one regular expression, so the text is evaluated and scanned once
    however many words there are.
    """
    words = [p[1:-1] for p in patterns]
    if all(len(p) > 2 and p[0] == p[-1] == "%" and not set(w) & set("%_\\") for p, w in zip(patterns, words)):
        return F.lower(text).rlike("|".join(re.escape(w.lower()) for w in words))
    hits = [text.ilike(p) for p in patterns]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out
