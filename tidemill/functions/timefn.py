"""Date macros and slot flooring as Columns over dates and zone-less timestamps."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def yesterday(d: Column) -> Column:
    return F.date_sub(d, 1)


def last_month(d: Column) -> Column:
    """The same day a month earlier, or that month's last day."""
    return F.add_months(d, -1)


def last_month_end(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "MM"), 1)


def last_weekday(d: Column) -> Column:
    """The nearest earlier day from Monday to Friday."""
    return F.date_sub(d, F.when(F.weekday(d) == 0, 3).when(F.weekday(d) == 6, 2).otherwise(1))


def macro(keyword: str, d: Column) -> Column:
    """A date keyword in its default format."""
    made = {
        "today": lambda: F.date_format(d, "yyyyMMdd"),
        "yesterday": lambda: F.date_format(yesterday(d), "yyyyMMdd"),
        "last_month": lambda: F.date_format(last_month(d), "yyyyMMdd"),
        "last_eom": lambda: F.date_format(last_month_end(d), "yyyyMMdd"),
        "last_yymm": lambda: F.date_format(last_month(d), "yyyyMM"),
        "last_bday": lambda: F.date_format(last_weekday(d), "yyyyMMdd"),
    }
    if keyword not in made:
        raise ValueError(f"unknown date keyword: {keyword}")
    return made[keyword]()


def macro_value(keyword: str, today: date, fmt: str | None = None) -> str:
    """The same for one day, on the driver; ``fmt`` is a strftime format."""
    first = today.replace(day=1)
    month_end = first - timedelta(days=1)
    month = month_end.replace(day=min(today.day, month_end.day))
    days = {"today": today, "yesterday": today - timedelta(days=1), "last_month": month, "last_eom": month_end, "last_yymm": month}
    days["last_bday"] = today - timedelta(days={0: 3, 6: 2}.get(today.weekday(), 1))
    if keyword not in days:
        raise ValueError(f"unknown date keyword: {keyword}")
    return days[keyword].strftime(fmt or ("%Y%m" if keyword == "last_yymm" else "%Y%m%d"))


def parse_cycle(cycle: str | None) -> tuple[int, str] | None:
    """(5, "m") of "5m"; None for a cycle that is no interval, such as daily."""
    m = re.fullmatch(r"(\d+)([mhdw])", (cycle or "").strip())
    return (int(m[1]), m[2]) if m else None


def floor_to(ts: Column, cycle: str | None) -> Column:
    """A zone-less timestamp floored to its slot: minutes within the hour, hours within the day, days from 1970-01-01, weeks from Monday 1970-01-05.

    A cycle that is no interval leaves it unchanged.
    """
    parsed = parse_cycle(cycle)
    if not parsed:
        return ts
    n, unit = parsed
    if n < 1:
        raise ValueError(f"an interval has a positive length: {cycle}")
    zero, seconds = F.lit(0), F.extract(F.lit("SECOND"), ts)
    if unit == "m":
        return ts - F.make_dt_interval(zero, zero, F.minute(ts) % n, seconds)
    if unit == "h":
        return ts - F.make_dt_interval(zero, F.hour(ts) % n, F.minute(ts), seconds)
    day = F.to_date(ts)
    if unit == "d":
        back = F.pmod(F.datediff(day, F.lit(date(1970, 1, 1))), F.lit(n))
    else:
        back = F.pmod(F.datediff(day, F.lit(date(1970, 1, 5))), F.lit(7 * n))
    return F.date_sub(day, back).cast("timestamp_ntz")


def stamp(ts: Column, cycle: str | None) -> Column:
    """The slot as yyyyMMddHHmmss."""
    return F.date_format(floor_to(ts, cycle), "yyyyMMddHHmmss")


def on_tick(ts: Column, start: str, end: str, minutes: int) -> Column:
    """Whether a schedule from ``start`` to ``end`` (HH:mm), Monday to Friday, every so many minutes, fires at this time."""
    at = F.date_format(ts, "HH:mm")
    return (F.weekday(ts) < 5) & at.between(start, end) & (F.minute(ts) % minutes == 0) & (F.second(ts) == 0)
