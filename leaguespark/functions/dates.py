"""Dates, seasons and windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date_time(text: Column) -> Column:
    """(value, heure_estimee) of ``dd/MM/yyyy`` with or without ``HH:mm``; null where unreadable."""
    timed = F.trim(text).rlike(r"\d{2}:\d{2}")
    value = F.when(timed, F.try_to_timestamp(F.trim(text), F.lit("dd/MM/yyyy HH:mm"))).otherwise(F.try_to_timestamp(F.trim(text), F.lit("dd/MM/yyyy")))
    return F.when(value.isNotNull(), F.struct(value.alias("value"), (~timed).alias("heure_estimee")))


def time_is_estimated(text: Column) -> Column:
    """Decided on the text: midnight of any zone means that no time was known."""
    return text.contains("T00:00:00")


def match_date(date_time: Column, round_start: Column) -> Column:
    """(date_heure, date_a_confirmer): the start of the round stands in for a missing date."""
    return F.struct(F.coalesce(date_time, F.to_timestamp(round_start)).alias("date_heure"), (date_time.isNull() & round_start.isNotNull()).alias("date_a_confirmer"))


def season_of(moment: Column) -> Column:
    """Seasons start on 1 July, UTC."""
    start = F.year(moment) - (F.month(moment) < 7).cast("int")
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def canonical_season(text: Column) -> Column:
    """``2025-2026`` from ``25-26``, ``2025/2026`` and the like; null unless the years follow each other."""
    trimmed = F.trim(text)
    years = lambda i: F.regexp_extract(trimmed, r"^(\d{4}|\d{2})[-/](\d{4}|\d{2})$", i)
    full = lambda y: y.try_cast("int") + F.when(F.length(y) == 2, 2000).otherwise(0)
    a, b = full(years(1)), full(years(2))
    return F.when((F.length(years(1)) == F.length(years(2))) & (b == a + 1), F.concat_ws("-", a.cast("string"), b.cast("string")))


def day(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def seconds(clock: Column) -> Column:
    """Seconds of ``mm:ss``."""
    part = lambda i: F.element_at(F.split(clock, ":"), i).try_cast("int")
    return part(1) * 60 + part(2)


def weekend_window(now: datetime) -> tuple[datetime, datetime]:
    """From Saturday to Monday (end excluded) of the ISO week of a moment."""
    monday = datetime(now.year, now.month, now.day) - timedelta(days=now.weekday())
    return monday + timedelta(days=5), monday + timedelta(days=7)


def live_window(now: datetime) -> tuple[datetime, datetime]:
    return now - timedelta(hours=2), now + timedelta(minutes=30)


def recent_window(now: datetime, days: int) -> tuple[datetime, datetime]:
    return now - timedelta(days=days), now


def in_window(moment: Column, window: tuple[datetime, datetime]) -> Column:
    """Half-open: the end does not belong."""
    return (moment >= F.lit(window[0])) & (moment < F.lit(window[1]))


def resolve_window(now: datetime, start: datetime | None = None, end: datetime | None = None, recent_days: int = 0, live: bool = False, weekend: bool = False) -> tuple[datetime, datetime] | None:
    """The window that is asked for: explicit bounds before recent days, live and weekend; None without any."""
    if start or end:
        window = start or datetime(1970, 1, 1), end or datetime(9999, 12, 31)
        if window[1] <= window[0]:
            raise ValueError("the window's end must come after its start")
        return window
    if recent_days > 0:
        return recent_window(now, recent_days)
    return live_window(now) if live else weekend_window(now) if weekend else None
