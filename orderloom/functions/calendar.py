"""Calendar and delivery features as column expressions.

Every function takes and returns Columns, so a whole table's features collapse
into one projection. Missing times fall into the last branch of each rule
(night, weekend, Sunday, December, timely); the caller decides whether such rows
survive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Names and hour bounds that results are compared on.
HOUR_BANDS = (("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 19))
OTHER_HOURS = "night"
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAY, WEEKEND = "weekday", "weekend"
EARLY, DELAYED, TIMELY = "early", "delayed", "timely"

#: How dayofweek numbers 1..7 (1 is a Sunday) are read. "shifted" calls number 1
#: Monday, which is the convention published results use; "calendar" is the true day.
CONVENTIONS = ("shifted", "calendar")


def _day_number(ts: Column, convention: str) -> Column:
    """1..7 counting from the day that the convention calls Monday."""
    if convention not in CONVENTIONS:
        raise ValueError(f"convention must be one of {CONVENTIONS}, not {convention!r}")
    return F.dayofweek(ts) if convention == "shifted" else F.weekday(ts) + 1


def _pick(names: tuple[str, ...], number: Column) -> Column:
    """names[number - 1]; a null number gives the last name."""
    table = F.array(*[F.lit(name) for name in names])
    return F.coalesce(F.get(table, number - 1), F.lit(names[-1]))


def time_of_day(ts: Column) -> Column:
    hour = F.hour(ts)
    bands = reduce(
        lambda rule, band: rule.when(hour.between(band[1], band[2]), band[0]), HOUR_BANDS, F
    )
    return bands.otherwise(OTHER_HOURS)


def weekday_flag(ts: Column, convention: str = "shifted") -> Column:
    return F.when(_day_number(ts, convention) <= 5, WEEKDAY).otherwise(WEEKEND)


def day_name(ts: Column, convention: str = "shifted") -> Column:
    return _pick(DAY_NAMES, _day_number(ts, convention))


def month_name(ts: Column) -> Column:
    return _pick(MONTH_NAMES, F.month(ts))


def days_between(end: Column, start: Column) -> Column:
    """Whole calendar days from start to end; null if either is missing."""
    return F.datediff(end, start)


def delivery_status(days_early: Column) -> Column:
    return F.when(days_early > 0, EARLY).when(days_early < 0, DELAYED).otherwise(TIMELY)
