"""Dates, times and elapsed marks over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms in which a date is written.
FORMS = ("MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy", "yyyy-MM-dd", "M-d-yyyy")


def free_date(x: Column) -> Column:
    """The date of a text in one of the usual forms, else null."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(x), F.lit(f)).cast("date") for f in FORMS))


def heading_date(text: Column, within: int = 12_000) -> Column:
    """The first "Month d, yyyy" of the years 1990 to 2100 in the head of a text, else null."""
    months = "January|February|March|April|May|June|July|August|September|October|November|December"
    found = F.regexp_extract(F.left(text, F.lit(within)), rf"(?i)\b((?:{months})\s+\d{{1,2}},?\s+(?:199\d|20\d\d|2100))\b", 1)
    return F.try_to_timestamp(F.initcap(F.regexp_replace(found, r"[,\s]+", " ")), F.lit("MMMM d yyyy")).cast("date")


def split_event_time(x: Column) -> tuple[Column, Column]:
    """(date, HH:MM) of a local time that wrongly ends in Z; it is never converted."""
    return F.substring(x, 1, 10), F.when(F.length(x) >= 16, F.substring(x, 12, 5)).otherwise("")


def clock(hhmm: Column) -> Column:
    """14:05 as 2:05 PM; empty stays empty."""
    hour = F.substring(hhmm, 1, 2).try_cast("int")
    twelve = F.when(F.pmod(hour, F.lit(12)) == 0, 12).otherwise(F.pmod(hour, F.lit(12)))
    return F.when(hour.isNull(), "").otherwise(F.concat(twelve.cast("string"), F.substring(hhmm, 3, 3), F.when(hour < 12, " AM").otherwise(" PM")))


def date_forms(iso: Column) -> Column:
    """A lower-case haystack of the ways people write a date."""
    d = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))
    forms = ("yyyy-MM-dd", "MMMM d yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "M/d/yyyy", "M/d/yy")
    return F.lower(F.concat_ws(" | ", *(F.date_format(d, f) for f in forms)))


def local_today(now: Column, zone: str) -> Column:
    return F.from_utc_timestamp(now, zone).cast("date")


def hms(seconds: Column) -> Column:
    s = seconds.cast("bigint")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def duration_label(seconds: Column) -> Column:
    minutes = F.floor(seconds / 60)
    return F.when(minutes >= 60, F.format_string("%dh %02dm", F.floor(minutes / 60), F.pmod(minutes, F.lit(60)))).otherwise(F.format_string("%dm", minutes))


def elapsed(mark: Column) -> Column:
    """Seconds of H:MM:SS or MM:SS, else null."""
    parts = F.split(mark, ":")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    return F.when(F.size(parts) == 3, number(0) * 3600 + number(1) * 60 + number(2)).when(F.size(parts) == 2, number(0) * 60 + number(1))


def publish_number(x: Column) -> Column:
    """The first fourteen digits of a time stamp as a number."""
    return F.left(F.regexp_replace(x, r"\D", ""), F.lit(14)).try_cast("bigint")


def term_years(start: Column, end: Column) -> Column:
    return F.concat(F.coalesce(F.left(start, F.lit(4)), F.lit("")), F.lit("–"), F.coalesce(F.left(end, F.lit(4)), F.lit("present")))


def recency(age_days: Column, weight: float, days: float) -> Column:
    """1 + weight * exp(-age / days); no true half-life."""
    return F.lit(1.0) + weight * F.exp(-F.greatest(age_days, F.lit(0)) / days)


def posted_on(text: Column) -> Column:
    """The day a certificate says a notice was posted on ("posted on this 13 day of August, 2026"), else null."""
    pattern = r"(?i)posted\s+on\s+this\s+(\d{1,2})\s*(?:st|nd|rd|th)?\s+day\s+of\s+([A-Za-z]+),?\s+(\d{4})"
    part = lambda k: F.regexp_extract(text, pattern, k)
    return F.try_to_timestamp(F.concat_ws(" ", F.initcap(part(2)), part(1), part(3)), F.lit("MMMM d yyyy")).cast("date")


def _shown(iso: Column, form: str) -> Column:
    """An ISO date in another form; what is no date stays as it is, null becomes empty."""
    return F.coalesce(F.date_format(F.try_to_timestamp(F.left(iso, F.lit(10)), F.lit("yyyy-MM-dd")), form), iso, F.lit(""))


def day_month_year(iso: Column) -> Column:
    """21 July 2026"""
    return _shown(iso, "d MMMM yyyy")


def month_day_year(iso: Column) -> Column:
    """Oct 8, 2026"""
    return _shown(iso, "MMM d, yyyy")


def weekday_date(iso: Column) -> Column:
    """Tuesday, July 21, 2026"""
    return _shown(iso, "EEEE, MMMM d, yyyy")


def instant(x: Column) -> Column:
    """The instant of an ISO text; without a zone it is UTC, what is none is null."""
    text = F.regexp_replace(F.trim(x), " ", "T")
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).when(text.rlike("T"), F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))
    return zoned.try_cast("timestamp")


def newest(*instants: Column) -> Column:
    """The latest of several instants, those unknown left out."""
    return F.array_max(F.array(*instants))
