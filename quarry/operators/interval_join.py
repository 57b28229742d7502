"""Joins on ranges and on alternatives of keys and ranges, without a nested loop.

Spark plans ``point BETWEEN low AND high`` without an equality as a nested
loop over all pairs. Here an interval is filed under the one or two buckets it
touches at a width that fits its own length, and a point under its bucket at
each width that occurs, so that the join is an equi-join on (keys, width,
bucket) whose pairs are checked exactly. The widths are powers of two: at most
64 for whole numbers and times, one where all intervals are equally long.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, FractionalType, IntegralType, TimestampNTZType,
                               TimestampType)


@dataclass(frozen=True)
class Alternative:
    """One disjunct: equal ``keys`` (left name, right name) and, if ``point`` (a
    right column's name) is given, a point between ``low`` and ``high`` (left
    expressions; both ends belong to the interval)."""
    keys: Sequence[tuple[str, str]] = field(default_factory=tuple)
    low: Column | None = None
    high: Column | None = None
    point: str | None = None

    def holds(self) -> Column:
        """The disjunct over both sides' columns, false where a part of it is null."""
        parts = [F.col(lk) == F.col(rk) for lk, rk in self.keys]
        if self.point is not None:
            parts += [F.col(self.point) >= self.low, F.col(self.point) <= self.high]
        return F.coalesce(reduce(and_, parts), F.lit(False))


LARGEST = sys.float_info.max


def _number(c: Column, kind) -> Column:
    """A column as a number in the same order: microseconds, days, longs, doubles."""
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, TimestampNTZType):
        days = F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
        return days + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * 1_000_000 + (F.extract(F.lit("SECONDS"), c) * 1_000_000).cast("long")
    if isinstance(kind, IntegralType):
        return c.cast("long")
    if isinstance(kind, (FractionalType, DecimalType)):
        x = c.cast("double")  # ends that aren't finite stand at the largest numbers; the exact check tells them apart
        return F.when(F.isnan(x), F.lit(LARGEST)).otherwise(F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)))
    raise TypeError(f"no range join over {kind.simpleString()}")


def _width(low: Column, high: Column, whole: bool) -> Column:
    """The exponent of the smallest power of two beyond the interval's length."""
    if whole:
        return F.coalesce(F.length(F.bin(F.try_subtract(high, low))), F.lit(63)).cast("int")
    length = high - low
    return F.when(length > 0, F.floor(F.greatest(F.least(F.log2(length), F.lit(1022.0)), F.lit(-1000.0))) + 1).otherwise(0).cast("int")


def _bucket(x: Column, width: Column, whole: bool) -> Column:
    """Order-preserving, so that a point between two ends lies between their buckets."""
    return F.call_function("shiftright", x, F.least(width, F.lit(63))) if whole else F.floor(x * F.pow(F.lit(2.0), -width))


def join_between(left: DataFrame, right: DataFrame, low: Column, high: Column, point: str,
                 keys: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Inner join on ``right.point BETWEEN low AND high`` and equal keys.

    ``low`` and ``high`` are expressions over left columns, of the type of
    ``point`` (numbers, dates or timestamps). Every pair comes once: a point
    has one bucket per width and an interval one width. Null keys, ends and
    points match nothing, nor does an interval whose ends are out of order;
    NaN is the largest double, as in Spark. Neither side is aggregated on the
    way, so AQE splits a hot bucket of either one. The frames must not share
    column names.
    """
    kind = right.schema[point].dataType
    whole = not isinstance(kind, (FractionalType, DecimalType))
    ends = left.withColumns({"_low": low, "_high": high}).where("_low <= _high")
    filed = ends.withColumns({"_lo": _number(F.col("_low"), left.select(low).schema[0].dataType),
                              "_hi": _number(F.col("_high"), left.select(high).schema[0].dataType)})
    filed = filed.withColumn("_width", _width(F.col("_lo"), F.col("_hi"), whole))
    # at most 64 widths for whole numbers, 2001 for doubles
    widths = sorted(r[0] for r in filed.select("_width").distinct().collect())
    if not widths:
        return left.join(right, F.lit(False))
    buckets = F.sequence(_bucket(F.col("_lo"), F.col("_width"), whole), _bucket(F.col("_hi"), F.col("_width"), whole))
    intervals = filed.withColumn("_bucket", F.explode(buckets)).drop("_lo", "_hi")
    points = right.where(F.col(point).isNotNull()).withColumn("_at", _number(F.col(point), kind)) \
        .withColumn("_point_width", F.explode(F.array(*[F.lit(w) for w in widths]))) \
        .withColumn("_point_bucket", _bucket(F.col("_at"), F.col("_point_width"), whole)).drop("_at")
    equal = [F.col(lk) == F.col(rk) for lk, rk in keys]
    met = intervals.join(points, reduce(and_, [*equal, F.col("_width") == F.col("_point_width"), F.col("_bucket") == F.col("_point_bucket")]))
    return met.where((F.col(point) >= F.col("_low")) & (F.col(point) <= F.col("_high"))) \
        .drop("_low", "_high", "_width", "_bucket", "_point_width", "_point_bucket")


def join_alternatives(left: DataFrame, right: DataFrame, alternatives: Sequence[Alternative]) -> DataFrame:
    """Inner join on ``A1 OR A2 OR ...``, each an ``Alternative``: one
    equi-join (or range join) per alternative, of which the later ones leave
    out the pairs that an earlier one holds for. Every pair comes once."""
    out = None
    for i, a in enumerate(alternatives):
        if a.point is not None:
            part = join_between(left, right, a.low, a.high, a.point, a.keys)
        elif a.keys:
            part = left.join(right, reduce(and_, [F.col(lk) == F.col(rk) for lk, rk in a.keys]))
        else:
            raise ValueError("an alternative needs keys or a range: anything else is a cross join")
        for earlier in alternatives[:i]:
            part = part.where(~earlier.holds())
        out = part if out is None else out.unionByName(part)
    return out
