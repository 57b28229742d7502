"""Column-level helpers; every function returns a ``Column`` (JVM-side,
inside whole-stage codegen) unless it is a UDF in ``quarry.functions.udfs``."""

from quarry.functions.scalar import (  # noqa: F401
    COMPACT_TS_FORMAT,
    DAY_TEXT_FORMAT,
    ISO_SECONDS_FORMAT,
    TRIP_TEXT_FORMAT,
    col_of,
    epoch_seconds,
    epoch_to_timestamp,
    fixed_round,
    format_date_text,
    in_list,
    parse_compact_timestamp,
    parse_date_text,
    parse_timestamp_text,
    safe_cast,
    salary_band,
    seconds_to_minutes,
    to_timestamp_text,
    wall_text,
    year_at_least,
    year_in_range,
)
