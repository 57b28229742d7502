"""Typed, null-safe Python UDFs (the slow path, kept for API parity).

The default way to turn seconds into minutes is the native expression
``quarry.functions.seconds_to_minutes``. When Python logic is genuinely
needed, it runs as an Arrow-batched pandas UDF with a declared return type:
no per-row serialisation, no string results, nulls pass through as nulls.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _minutes(seconds: pd.Series) -> pd.Series:
    # the rounding of fixed_round, so that both forms give the same digits
    return np.floor(seconds.astype("float64") / 60.0 * 1000.0 + 0.5) / 1000.0


minutes_udf = F.pandas_udf(_minutes, DoubleType())
"""Seconds to minutes with three decimals as a vectorised UDF; null in, null out."""


def register_minutes_udf(spark: SparkSession, name: str = "to_minutes") -> str:
    """Register the vectorised minutes UDF for SQL use (``SELECT to_minutes(x)``)."""
    spark.udf.register(name, minutes_udf)
    return name


def define_minutes_function(spark: SparkSession, name: str) -> str:
    """The same rounding as a temporary function defined in SQL: no Python runs, and the optimizer sees its body."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(seconds DOUBLE) RETURNS DOUBLE "
              "COMMENT 'seconds to minutes with three decimals' RETURN floor(seconds / 60.0D * 1000.0D + 0.5D) / 1000.0D")
    return name
