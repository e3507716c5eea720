"""Timestamps of log lines. Every default comes from an explicit reference time (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import DATE_SHAPE, DATETIME_SHAPE, LONG_MONTH_NAMES, MONTH_NAMES, PLAIN_DATE, TIME_SHAPE

_BSD = (
    r"^ *([A-Za-z]{3}) +([+-]?\d{1,9}) +"
    r":*([+-]?\d{1,9}):+([+-]?\d{1,9}):+([+-]?\d{1,9}):* *$"
)
_LOOSE_BSD = r"^[ \t]*([A-Za-z]{3})\s+(\d{1,2})\s+(\d\d):(\d\d):(\d\d)"


def is_datetime_token(col: Column) -> Column:
    """ISO date-time, plain date or plain time."""
    return col.rlike(f"^(?:{DATETIME_SHAPE}|{DATE_SHAPE}|{TIME_SHAPE})$")


def month_number(name: Column) -> Column:
    """1 to 12 for a three-letter or full name in any case, else null."""
    at = lambda names: F.nullif(F.array_position(F.array(*map(F.lit, names)), F.lower(name)).cast("int"), F.lit(0))
    return F.coalesce(at(MONTH_NAMES), at(LONG_MONTH_NAMES))


def _lenient(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """Days past the month's end and hour 24 roll over, as a lenient calendar does."""
    first = F.unix_timestamp(F.make_timestamp(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    offset = (day - 1) * 86400 + hour * 3600 + minute * 60 + second
    return F.timestamp_seconds(first + offset)


def _parts(col: Column, regex: str) -> list[Column]:
    month = month_number(F.regexp_extract(col, regex, 1))
    return [month] + [F.regexp_extract(col, regex, i).try_cast("int") for i in range(2, 6)]


def parse_bsd_time(col: Column, ref_time: Column) -> Column:
    """``MMM d H:m:s`` in the reference time's year; out of range gives null."""
    month, day, hour, minute, second = _parts(col, _BSD)
    valid = (
        month.isNotNull() & day.between(1, 31) & hour.between(0, 24)
        & minute.between(0, 59) & second.between(0, 59)
    )
    return F.when(valid, _lenient(F.year(ref_time), month, day, hour, minute, second))


def parse_line_date(col: Column, ref_time: Column) -> Column:
    """``yyyy-M-d`` or ``MMM d HH:mm:ss``, with overflowing parts rolled over; else null."""
    month, day, hour, minute, second = _parts(col, _LOOSE_BSD)
    part = lambda i: F.regexp_extract(col, PLAIN_DATE, i).try_cast("int")
    zero = F.lit(0)
    return F.when(
        col.rlike(PLAIN_DATE), _lenient(part(1), part(3), part(4), zero, zero, zero)
    ).when(month.isNotNull(), _lenient(F.year(ref_time), month, day, hour, minute, second))


def format_bsd_time(col: Column) -> Column:
    return F.date_format(col, "MMM dd HH:mm:ss")


def format_rfc3339(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso_time(col: Column) -> Column:
    """ISO date-time with an optional fraction and ``Z`` or an offset (colon optional)."""
    text = F.regexp_replace(col, r"([-+]\d\d):?(\d\d)$", "$1:$2")
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[-+]\d\d:\d\d)$")
    # A fraction is cut to micros; more digits than that cannot be kept.
    text = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.when(shaped, F.try_to_timestamp(text))


TIME_FIELDS = ["isotimestamp", "date", "timestamp", "year", "month", "day"]


def event_time_of(fields: dict[str, Column], ref_time: Column) -> Column:
    """Event time from the extracted time fields, given as columns.

    An ISO time wins; else ``date`` and ``timestamp``; else a ``timestamp`` with a date of its
    own; else month, day, year and time, with missing parts taken from ``ref_time``. Values are
    read whole: a text that is not all month name, number or clock time gives ``ref_time``.
    Fractions of a second are kept to micros. The time-zone field is ignored.
    """
    part = lambda name: F.nullif(fields[name], F.lit("-"))
    iso, date, time = part("isotimestamp"), fields["date"], fields["timestamp"]
    month = F.when(part("month").isNull(), F.month(ref_time)).otherwise(F.coalesce(
        part("month").try_cast("int"), month_number(fields["month"])
    ))
    day = F.when(part("day").isNull(), F.dayofmonth(ref_time)).otherwise(part("day").try_cast("int"))
    year = F.when(part("year").isNull(), F.year(ref_time)).otherwise(part("year").try_cast("int"))
    day_micros = 86_400_000_000
    plain = r"^\d{4}-\d{2}-\d{2}$"
    time_text = F.translate(time, "/", "-")
    dated = F.when(time_text.rlike(plain), time_text.try_cast("timestamp")).otherwise(parse_iso_time(time_text))
    clock = r"^([01]\d|2[0-3]):([0-5]\d):([0-5]\d)(?:\.(\d+))?$"
    piece = lambda i: F.regexp_extract(time, clock, i)
    seconds = piece(1).cast("bigint") * 3600 + piece(2).cast("bigint") * 60 + piece(3).cast("bigint")
    timed = F.when(time.isNull(), F.lit(0).cast("bigint")).when(
        time.rlike(clock), seconds * 1_000_000 + F.rpad(F.substring(piece(4), 1, 6), 6, "0").cast("bigint")
    ).otherwise(F.pmod(F.unix_micros(dated), F.lit(day_micros)))
    at = lambda d: F.timestamp_micros(F.unix_micros(d.cast("timestamp")) + timed)
    # Parts that form no date give null through the cast, not an error.
    built = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"),
                        F.lpad(day.cast("string"), 2, "0")).try_cast("date")
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    iso_text = F.translate(iso, "/", "-")
    date_text = F.translate(date, "/", "-")
    return F.coalesce(
        F.when(iso.isNotNull(), F.when(iso_text.rlike(plain), iso_text.try_cast("timestamp")).otherwise(
            parse_iso_time(iso_text)))
        .when(date.isNotNull(), F.when(date_text.rlike(plain), at(date_text.try_cast("date"))).otherwise(
            parse_iso_time(date_text)))
        .when(dated.isNotNull(), dated)
        .when(known, at(built)),
        ref_time,
    )


def parse_event_time(params: Column, ref_time: Column) -> Column:
    """``event_time_of`` the fields of a params map. They are read many times: give a finished column
    (``compute_once``), not the expression that makes the map."""
    return event_time_of({n: F.try_element_at(params, F.lit(n)) for n in TIME_FIELDS}, ref_time)
