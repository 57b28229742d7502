"""Elastic net by coordinate descent over the sums of products of one pass.

One aggregate gives the means, deviations and covariances of all columns; the
descent then runs on that small matrix, so its sweeps cost nothing that grows
with the rows. The objective is that of ``pyspark.ml`` (normal solver): features
and label are scaled by their deviations, the penalty ``reg`` by the label's, and

    1/(2n) |y - X b|^2 + reg (alpha |b|_1 + (1 - alpha)/2 |b|^2)

is least at the scaled coefficients b. A fit carries, per term, how far the
condition of the optimum is from being met.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import fixed_round

#: Features of one fit: the pass computes a covariance for each pair.
MAX_FEATURES = 64


@dataclass(frozen=True)
class Moments:
    """n, means, deviations and covariances (all over n) of features and label (the last place)."""
    names: tuple[str, ...]
    n: int
    mean: np.ndarray
    deviation: np.ndarray
    covariance: np.ndarray


@dataclass(frozen=True)
class ElasticFit:
    names: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float
    rmse: float
    r2: float | None
    gaps: np.ndarray        # distance from the optimality condition, in scaled units
    sweeps: int


def moments(df: DataFrame, features: Sequence[str], label: str) -> Moments:
    """All sums in one aggregate. Rows with a null in any of the columns are left out."""
    names = [*features, label]
    if len(features) > MAX_FEATURES:
        raise ValueError(f"{len(features)} features; at most {MAX_FEATURES} (fit_linear takes more)")
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna()
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(names)):
        aggs += [F.avg(f"x{i}").alias(f"m{i}"), F.stddev_pop(f"x{i}").alias(f"s{i}")]
        aggs += [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for j in range(i + 1)]
    row = rows.agg(*aggs).first()
    p = len(names)
    value = lambda k: float("nan") if row[k] is None else float(row[k])
    covariance = np.array([[value(f"c{max(i, j)}_{min(i, j)}") for j in range(p)] for i in range(p)])
    return Moments(tuple(names), int(row["n"]), np.array([value(f"m{i}") for i in range(p)]),
                   np.array([value(f"s{i}") for i in range(p)]), covariance)


def soft(x: float, threshold: float) -> float:
    return float(np.sign(x) * max(abs(x) - threshold, 0.0))


def coordinate_descent(m: Moments, reg: float, alpha: float, *, tol: float = 1e-13, max_sweeps: int = 10_000) -> ElasticFit:
    """The fit at one penalty. A constant feature has the coefficient 0; a
    constant label gives all coefficients 0. Fewer than two rows are refused."""
    if m.n < 2:
        raise ValueError("a fit needs two rows")
    if reg < 0 or not 0 <= alpha <= 1:
        raise ValueError("reg must not be negative, alpha between 0 and 1")
    p = len(m.names) - 1
    scale, own = m.deviation[:p], m.deviation[p]
    b = np.zeros(p)
    live = [j for j in range(p) if scale[j] > 0] if own > 0 else []
    sweeps = 0
    l1, l2 = (reg / own * alpha, reg / own * (1 - alpha)) if own > 0 else (0.0, 0.0)
    unit = np.where(scale > 0, scale, 1.0)
    gram = m.covariance[:p, :p] / np.outer(unit, unit)
    target = m.covariance[:p, p] / (unit * own) if own > 0 else np.zeros(p)
    while live and sweeps < max_sweeps:
        before = b.copy()
        for j in live:
            rest = target[j] - gram[j] @ b + gram[j, j] * b[j]
            b[j] = soft(rest, l1) / (gram[j, j] + l2)
        sweeps += 1
        if np.abs(b - before).max() <= tol * max(1.0, np.abs(b).max()):
            break
    slope = target - gram @ b - l2 * b  # at the optimum: l1 * sign(b), or within l1 where b is 0
    gaps = np.where(b != 0, np.abs(slope - l1 * np.sign(b)), np.maximum(np.abs(slope) - l1, 0.0))
    gaps[[j for j in range(p) if j not in live]] = 0.0
    coefficients = b * own / unit
    spread = m.covariance[p, p]
    error = max(spread - 2 * coefficients @ m.covariance[:p, p] + coefficients @ m.covariance[:p, :p] @ coefficients, 0.0)
    return ElasticFit(m.names[:p], coefficients, float(m.mean[p] - coefficients @ m.mean[:p]), float(np.sqrt(error)),
                      float(1 - error / spread) if spread > 0 else None, gaps, sweeps)


def fit_elastic_net(df: DataFrame, features: Sequence[str], label: str, reg: float, alpha: float) -> ElasticFit:
    return coordinate_descent(moments(df, features, label), reg, alpha)


def fit_frame(spark: SparkSession, fits: dict[str, ElasticFit], digits: int = 3) -> DataFrame:
    """fit, term, kind, value (rounded), gap (to six digits; null where there is no condition)."""
    rows = []
    for name, f in fits.items():
        rows += [(name, t, "coefficient", float(c), float(g)) for t, c, g in zip(f.names, f.coefficients, f.gaps)]
        rows += [(name, "intercept", "intercept", f.intercept, None), (name, "rmse", "metric", f.rmse, None), (name, "r2", "metric", f.r2, None)]
    return spark.createDataFrame(rows, "fit string, term string, kind string, value double, gap double") \
        .withColumn("value", F.when(F.col("term") == "r2", fixed_round("value", 9)).otherwise(fixed_round("value", digits))) \
        .withColumn("gap", fixed_round("gap", 6))
