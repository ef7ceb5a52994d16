"""Time scalar expressions. Timestamps stay typed (TIMESTAMP_NTZ, wall clock)
inside plans; strings appear only at the boundaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampere.functions.util import as_col

# English month abbreviations, January first.
MONTH_ABBR = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# The reading-time label, "<weekday> <Mon> <day>, <h> AM|PM - ...";
# the day may be preceded by two blanks.
READING_TIME_PATTERN = r"^\w+ (\w+)\s+(\d+), (\d+) (AM|PM)"


def to_ntz(c) -> Column:
    return as_col(c).cast("timestamp_ntz")


def trunc_ntz(unit: str, c) -> Column:
    """``date_trunc`` that stays TIMESTAMP_NTZ (date_trunc returns TIMESTAMP)."""
    return F.date_trunc(unit, as_col(c)).cast("timestamp_ntz")


def calendar_columns(ts) -> dict[str, Column]:
    """hour / day / month buckets of a timestamp."""
    return {
        "hour": trunc_ntz("hour", ts),
        "day": trunc_ntz("day", ts),
        "month": trunc_ntz("month", ts),
    }


def hour_ending_to_start(date_col, hour_col) -> Column:
    """Date + hour-ending 1..24 → hour-starting timestamp (F11):
    hour 1 → 00:00 of the date, hour 24 → 23:00."""
    base = F.to_date(as_col(date_col)).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", as_col(hour_col).cast("int") - F.lit(1), base)


def iso_hour(ts) -> Column:
    """``yyyy-MM-ddTHH:00:00``."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:00:00")


def iso_seconds(ts) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def to_utc_naive(c) -> Column:
    """Offset-bearing ISO string → UTC wall clock, naive strings taken as UTC
    (F13). Relies on the session time zone being UTC (see ``session``)."""
    return F.to_timestamp(as_col(c)).cast("timestamp_ntz")


def localize(ts, source_tz: str | None) -> Column:
    """Naive local wall clock in ``source_tz`` → naive UTC; identity if None."""
    if not source_tz:
        return as_col(ts)
    return F.to_utc_timestamp(as_col(ts), source_tz).cast("timestamp_ntz")


def parse_long_date(c) -> Column:
    """``May 1, 2024`` → DATE (F15); unparsable → NULL."""
    return F.try_to_timestamp(as_col(c), F.lit("MMMM d, yyyy")).cast("date")


def parse_reading_time(c, asof, strict: bool = False) -> Column:
    """``'Thu Oct 14, 8 AM - 9 AM'`` → hour-start TIMESTAMP_NTZ.

    Weekday ignored; 12 AM → 0 and 12 PM → 12; the year is ``asof``'s year,
    minus one when ``asof`` is in January and the label is in December.
    Unparsable labels give NULL, or fail the query when ``strict``.
    """
    c = as_col(c)
    asof = F.lit(asof) if isinstance(asof, (str, dt.date)) else as_col(asof)
    asof = asof.cast("date")
    # one regex pass: a matching label becomes "Mon|d|h|AM"; others stay as they are
    canon = F.regexp_replace(c, "(?s)" + READING_TIME_PATTERN + ".*$", "$1|$2|$3|$4")
    hit = canon != c
    parts = F.split(canon, r"\|")
    mon = F.array_position(F.array(*[F.lit(m) for m in MONTH_ABBR]), F.lower(parts.getItem(0)))
    day = parts.getItem(1).try_cast("int")
    h12 = parts.getItem(2).try_cast("int")
    pm = parts.getItem(3) == F.lit("PM")
    hour = (
        F.when(pm & (h12 != 12), h12 + 12)
        .when(~pm & (h12 == 12), F.lit(0))
        .otherwise(h12)
    )
    year = F.year(asof) - F.when((F.month(asof) == 1) & (mon == 12), 1).otherwise(0)
    ts = F.when(
        hit & (mon > 0),
        F.try_make_timestamp_ntz(year, mon.cast("int"), day, hour, F.lit(0), F.lit(0)),
    )
    if strict:
        return F.when(
            c.isNotNull() & ts.isNull(),
            F.raise_error(F.concat(F.lit("unexpected reading-time label: "), c)),
        ).otherwise(ts)
    return ts


def next_month_start(d) -> Column:
    """First day of the month after ``d``."""
    return F.add_months(F.trunc(as_col(d), "MM"), 1)


def epoch_ms(ts) -> Column:
    """Milliseconds since the epoch of a naive (UTC) timestamp."""
    return F.unix_millis(as_col(ts).cast("timestamp"))


def seconds_between(later, earlier) -> Column:
    """``later - earlier`` in (fractional) seconds, as double."""
    lat = F.unix_micros(as_col(later).cast("timestamp"))
    ear = F.unix_micros(as_col(earlier).cast("timestamp"))
    return (lat - ear).cast("double") / F.lit(1e6)
