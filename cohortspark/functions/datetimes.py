"""Date, time, pattern and series functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortspark.operators.grouped import elapsed

# Seconds per unit, and the supported format marks.
SECONDS = {"SECOND": 1.0, "MINUTE": 60.0, "HOUR": 3600.0, "DAY": 24 * 3600.0, "YEAR": 365.242 * 24 * 3600.0}
MARKS = {"%S": "ss", "%M": "mm", "%H": "HH", "%d": "dd", "%m": "MM", "%Y": "yyyy"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def datetime_diff(end: Column | str, start: Column | str, unit: str) -> Column:
    """Elapsed time in a unit, with its fraction; null for an unknown unit."""
    if unit not in SECONDS:
        return F.lit(None).cast("double")
    return elapsed(_col(end), _col(start)).cast("double") / F.lit(SECONDS[unit])


def seconds(n: Column | float) -> Column:
    """Interval of n seconds."""
    n = n if isinstance(n, Column) else F.lit(float(n))
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def datetime_add(ts: Column | str, n: Column | float, unit: str = "SECOND") -> Column:
    return _col(ts) + seconds(n * SECONDS[unit])


def datetime_sub(ts: Column | str, n: Column | float, unit: str = "SECOND") -> Column:
    return _col(ts) - seconds(n * SECONDS[unit])


def datetime(*parts: Column | str) -> Column:
    """Timestamp of a date, or of year, month, day, hour, minute and second."""
    if len(parts) == 1:
        return _col(parts[0]).cast("timestamp_ntz")
    year, month, day, hour, minute, second = (_col(p) for p in parts)
    return F.make_timestamp_ntz(year, month, day, hour, minute, second)


def pattern(fmt: str) -> str:
    """Spark date pattern of a ``%Y-%m-%d %H:%M:%S`` style format; other letters are quoted."""
    out, i = "", 0
    while i < len(fmt):
        mark = fmt[i : i + 2]
        if mark in MARKS:
            out, i = out + MARKS[mark], i + 2
        else:
            out, i = out + (f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]), i + 1
    return out


def format_datetime(fmt: str, ts: Column | str) -> Column:
    return F.date_format(_col(ts), pattern(fmt))


format_date = format_datetime


def parse_date(fmt: str, text: Column | str) -> Column:
    return F.to_date(_col(text), pattern(fmt))


def parse_datetime(fmt: str, text: Column | str) -> Column:
    return F.to_timestamp_ntz(_col(text), F.lit(pattern(fmt)))


def regexp_extract_or_null(text: Column | str, regex: str) -> Column:
    """First match (its first capture group when there is one), or null without a match.  ``regex`` is in Java's syntax."""
    if _has_group(regex):
        return F.when(F.rlike(_col(text), F.lit(regex)), F.regexp_extract(_col(text), regex, 1))
    return F.regexp_substr(_col(text), F.lit(regex))


def _has_group(regex: str) -> bool:
    """Whether a pattern captures: an opening bracket outside of escapes, quotes and character classes that no ``?``
    follows, or one of a named group."""
    plain = re.sub(r"\\Q.*?(\\E|$)|\\.", "", regex, flags=re.DOTALL)
    while (inner := re.sub(r"\[[^\[\]]*\]", "", plain)) != plain:
        plain = inner
    return bool(re.search(r"\((?!\?)|\(\?<(?![=!])", plain))


def regexp_contains(text: Column | str, regex: str) -> Column:
    return F.rlike(_col(text), F.lit(regex))


def generate_array(i: Column | int, j: Column | int) -> Column:
    """Rows i, i+1, ..., j (none when j is before i)."""
    i = i if isinstance(i, Column) else F.lit(i)
    j = j if isinstance(j, Column) else F.lit(j)
    return F.explode(F.when(i <= j, F.sequence(i, F.greatest(i, j))).otherwise(F.array().cast("array<int>")))
