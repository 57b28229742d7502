"""Scalar expressions: dates, text timestamps, banding, casts, arithmetic.

All of these build Catalyst expressions, so they stay in whole-stage
codegen and are pushed down where the source supports it. ANSI mode is
assumed on: parsing and casting of dirty text go through the ``try_*``
forms, which yield null instead of failing the job.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "year_at_least",
    "year_in_range",
    "parse_date_text",
    "format_date_text",
    "parse_compact_timestamp",
    "parse_timestamp_text",
    "epoch_seconds",
    "to_timestamp_text",
    "salary_band",
    "fixed_round",
    "seconds_to_minutes",
    "epoch_to_timestamp",
    "safe_cast",
    "in_list",
    "TRIP_TEXT_FORMAT",
    "wall_text",
    "ISO_SECONDS_FORMAT",
    "DAY_TEXT_FORMAT",
    "COMPACT_TS_FORMAT",
]

# The text layouts used by the bike-trip and housing data.
TRIP_TEXT_FORMAT = "M/d/yyyy H:m"
DAY_TEXT_FORMAT = "MM/dd/yyyy"
COMPACT_TS_FORMAT = "yyyyMMdd'T'HHmmss"
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_at_least(c: str, year: int, *, ntz: bool = True) -> Column:
    """``year(c) >= year`` written as a range on the raw column.

    ``year(c) >= n`` is opaque to the Parquet reader (only ``IsNotNull``
    is pushed); ``c >= 'n-01-01'`` is pushed and prunes row groups.
    """
    return F.col(c) >= _ts_literal(_dt.datetime(year, 1, 1), ntz)


def year_in_range(c: str, first: int | None = None, last: int | None = None, *,
                  ntz: bool = True) -> Column:
    """``first <= year(c) <= last`` as a pushable half-open range."""
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(c) >= _ts_literal(_dt.datetime(first, 1, 1), ntz))
    if last is not None:
        cond = cond & (F.col(c) < _ts_literal(_dt.datetime(last + 1, 1, 1), ntz))
    return cond


def _ts_literal(value: _dt.datetime, ntz: bool) -> Column:
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def parse_timestamp_text(c: str | Column, fmt: str) -> Column:
    """Text to ``timestamp_ntz`` with an explicit pattern; bad text is null.

    ``to_timestamp_ntz`` reads the wall time exactly whatever the session
    time zone (``try_to_timestamp`` would move wall times that fall into a
    daylight-saving gap of the session zone); it raises on bad text under
    ANSI, so it only runs where the lenient ``try_to_timestamp`` succeeded.
    """
    x = col_of(c)
    return F.when(F.try_to_timestamp(x, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(x, F.lit(fmt)))


def parse_date_text(c: str | Column, fmt: str = TRIP_TEXT_FORMAT) -> Column:
    """Text to ``date`` with an explicit pattern; unparseable text is null.

    One lenient parse: a wall time inside a daylight-saving gap of the
    session zone moves forward by less than an hour, so its date is kept.
    """
    return F.try_to_date(col_of(c), fmt)


def format_date_text(c: str | Column, fmt: str = DAY_TEXT_FORMAT) -> Column:
    """Date or timestamp to text. Group and sort on the date, format last:
    ``MM/dd/yyyy`` text does not sort chronologically across years."""
    return F.date_format(col_of(c), fmt)


def parse_compact_timestamp(c: str | Column, fmt: str = COMPACT_TS_FORMAT) -> Column:
    """Compact text such as ``20141013T000000`` to ``timestamp_ntz``.

    Kept as a real timestamp (not the string ``from_unixtime`` returns), and
    wall-clock based, so the result does not depend on the session time zone.
    """
    return parse_timestamp_text(c, fmt)


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970-01-01 of a ``timestamp_ntz`` read as UTC wall time."""
    return F.unix_timestamp(col_of(c))


def to_timestamp_text(c: str | Column) -> Column:
    """ISO-like text to ``timestamp_ntz``; null (not an error) on bad text.
    A cast, so wall times are kept whatever the session time zone."""
    return col_of(c).try_cast("timestamp_ntz")


# pattern letter -> (field of the wall time, zero-padded width; 0 = no padding)
_WALL_FIELDS = {
    "yyyy": (F.year, 4), "MM": (F.month, 2), "M": (F.month, 0), "dd": (F.dayofmonth, 2),
    "d": (F.dayofmonth, 0), "HH": (F.hour, 2), "H": (F.hour, 0), "mm": (F.minute, 2),
    "m": (F.minute, 0), "ss": (F.second, 2), "s": (F.second, 0),
}
_WALL_TOKENS = re.compile(r"'[^']*'|yyyy|MM|M|dd|d|HH|H|mm|m|ss|s|.")


def wall_text(c: str | Column, pattern: str) -> Column:
    """``timestamp_ntz`` to text from its wall-clock fields.

    ``date_format`` converts a ``timestamp_ntz`` through the session time
    zone, which moves wall times inside a daylight-saving gap. This builds
    the text from year..second with ``concat``/``lpad`` (codegen, no
    per-row formatter) and accepts the numeric subset of the
    ``date_format`` pattern letters (yyyy, M, MM, d, dd, H, HH, m, mm, s,
    ss, and 'quoted' literals).
    """
    x = col_of(c)
    parts = []
    for tok in _WALL_TOKENS.findall(pattern):
        if tok in _WALL_FIELDS:
            field, width = _WALL_FIELDS[tok]
            text = field(x).cast("string")
            parts.append(F.lpad(text, width, "0") if width else text)
        else:
            parts.append(F.lit(tok[1:-1] if tok.startswith("'") else tok))
    return F.concat(*parts)


def salary_band(c: str | Column, width: float = 10_000) -> Column:
    """Band number ``round(c / width)`` with HALF_UP rounding, as int.

    With the default width 23,000 gives 2 and 57,400 gives 6; note that
    rounding (not flooring) puts 25,000 in band 3 and 20,000-24,999 in 2.
    """
    return F.round(col_of(c) / F.lit(float(width))).cast("int")


def fixed_round(c: str | Column, digits: int | None) -> Column:
    """``floor(c * 10^d + 0.5) / 10^d`` as double; unrounded if digits is None.

    A rounding that every engine computes bit-identically from the same
    double (no decimal-string detour), used for reporting aggregates whose
    last bits depend on addition order. NaN, infinities and values of which
    ``c * 10^d`` reaches 2^53 have no such digits and are returned unchanged.
    """
    x = col_of(c).cast("double")
    if digits is None:
        return x
    scale = F.lit(float(10 ** digits))
    return F.when(F.abs(x * scale) >= F.lit(float(2 ** 53)), x) \
        .otherwise((F.floor(x * scale + F.lit(0.5)) / scale).cast("double"))


def seconds_to_minutes(c: str | Column, digits: int | None = None) -> Column:
    """Minutes from seconds, rounded by ``fixed_round`` if digits are given."""
    return fixed_round(col_of(c).cast("double") / F.lit(60.0), digits)


def epoch_to_timestamp(c: str | Column) -> Column:
    """Seconds since 1970-01-01 to the ``timestamp_ntz`` of that UTC wall time
    (the inverse of ``epoch_seconds``, whatever the session time zone)."""
    return F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) \
        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col_of(c))


def safe_cast(c: str | Column, dtype: str) -> Column:
    """``try_cast``: bad text or overflow becomes null instead of an error."""
    return col_of(c).try_cast(dtype)


def in_list(c: str | Column, values) -> Column:
    return col_of(c).isin(list(values))
