"""Random numbers per row that depend on a seed and a key alone.

``F.rand`` draws in the order of a partition's rows, so its numbers change
with the layout of the table and when a lost task is run again elsewhere.
These are counters through a hash: the same key has the same number under any
partitioning, on any cluster, and in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits of one number: 52 bits, so that every value is an exact double.
DIGITS = 13


def _draw(seed: int, key: str | Column, place: int) -> Column:
    """Uniform in (0, 1): the middle of one of 2^52 equal steps. ``place`` 0 and 1 are independent."""
    k = F.col(key) if isinstance(key, str) else key
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    whole = F.conv(F.substring(hashed, 1 + place * DIGITS, DIGITS), 16, 10).cast("long")
    return (whole.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def uniform(seed: int, key: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Uniform between low and high; null for a null key."""
    return F.lit(float(low)) + F.lit(float(high) - float(low)) * _draw(seed, key, 0)


def normal(seed: int, key: str | Column, mean: float = 0.0, deviation: float = 1.0) -> Column:
    """Normal by the Box-Muller transform of two uniform numbers; null for a null key."""
    radius = F.sqrt(F.lit(-2.0) * F.log(_draw(seed, key, 0)))
    return F.lit(float(mean)) + F.lit(float(deviation)) * radius * F.cos(F.lit(2.0 * math.pi) * _draw(seed, key, 1))
