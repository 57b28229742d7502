"""Tabular regression workflow on Spark: index, assemble, split, fit, score,
residual analysis.

Everything that touches rows is distributed. Only bounded results come
to the driver: the coefficients of a fitted model (one number per
feature) and a scalar RMSE, exactly as Spark ML's own models do.

* Category indexes are built from the distinct values of a column (a
  small table, bounded by its cardinality), ranked there, and joined back.
* The train/test split hashes a key, so it does not depend on partition
  layout (``randomSplit`` draws per partition and changes when the
  input is repartitioned).
* One-feature least squares is closed form (``regr_slope``/``regr_intercept``
  in one pass). Multi-feature fits use ``pyspark.ml``: normal equations
  (one pass for any elastic net, the iterations run on a small matrix), or
  l-bfgs with one pass over persisted rows per iteration.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from quarry.functions.scalar import fixed_round
from quarry.operators.profile import _lit
from quarry.operators.relational import with_global_position

# --------------------------------------------------------------------------- indexing

def fit_index(df: DataFrame, column: str, order: str = "frequencyDesc") -> DataFrame:
    """Label table (value, index) for a string column, nulls excluded.

    ``frequencyDesc``: most frequent value gets 0, ties alphabetical (the
    order of ``pyspark.ml.feature.StringIndexer``). ``alphabetAsc``:
    index = rank of the value in sort order (a local ``LabelEncoder``).

    The distinct values are ranked by ``with_global_position`` (range
    partitioned sort plus per-partition offsets), so even a column with
    billions of distinct values is ranked without a one-task window; the
    ranked table is checkpointed, so its size check and the join that
    applies it do not rescan the source.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    if order == "frequencyDesc":
        keys = [F.col("_n").desc(), F.col(column).asc()]
    elif order == "alphabetAsc":
        keys = [F.col(column).asc()]
    else:
        raise ValueError("order must be 'frequencyDesc' or 'alphabetAsc'")
    ranked = with_global_position(values, keys, "_pos")
    return ranked.select(column, (F.col("_pos") - 1).cast("double").alias("_index"))


def apply_index(df: DataFrame, labels: DataFrame, column: str, out_col: str,
                handle_invalid: str = "error") -> DataFrame:
    """Map values to indexes. Values absent from ``labels`` (and nulls):
    ``error`` fails the job, ``keep`` maps them to ``len(labels)``,
    ``skip`` drops the row. The join strategy is left to AQE."""
    lab = labels.withColumnRenamed("_index", out_col)
    out = df.join(lab, on=column, how="left")
    if handle_invalid == "skip":
        return out.where(F.col(out_col).isNotNull())
    if handle_invalid == "keep":
        n = labels.count()
        return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(float(n))))
    if handle_invalid == "error":
        return out.withColumn(out_col, F.when(F.col(out_col).isNull(), F.raise_error(
            F.concat(F.lit(f"unseen or null label in {column}: "),
                     F.coalesce(F.col(column).cast("string"), F.lit("NULL")))))
            .otherwise(F.col(out_col)))
    raise ValueError("handle_invalid must be error, keep or skip")


def index_column(df: DataFrame, column: str, out_col: str, order: str = "frequencyDesc",
                 handle_invalid: str = "error") -> DataFrame:
    return apply_index(df, fit_index(df, column, order), column, out_col, handle_invalid)


# --------------------------------------------------------------------------- features

def feature_pipeline(index_cols: Sequence[str], numeric_cols: Sequence[str],
                     out_col: str = "features", handle_invalid: str = "keep") -> Pipeline:
    """``pyspark.ml`` pipeline: index each string column by frequency, then
    assemble the numeric and index columns into one vector.

    ``StringIndexer`` brings the distinct labels of each column to the
    driver when fitted, so this suits low-cardinality columns; for columns
    whose distinct values grow with the data use ``index_column`` (ranked
    and joined on the executors) followed by ``assemble``.
    """
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid=handle_invalid)
                for c in index_cols]
    assembler = VectorAssembler(inputCols=[*numeric_cols, *[f"{c}_index" for c in index_cols]],
                                outputCol=out_col, handleInvalid="error")
    return Pipeline(stages=[*indexers, assembler])


def assemble(df: DataFrame, inputs: Sequence[str], out_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns to one vector column (``VectorAssembler``)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=out_col,
                           handleInvalid=handle_invalid).transform(df)


def vector_elements(df: DataFrame, vec_col: str, names: Sequence[str]) -> DataFrame:
    """Unpack a vector into named double columns (for inspection and export)."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*[c for c in df.columns if c != vec_col],
                     *[arr[i].alias(n) for i, n in enumerate(names)])


def hash_bucket(key: str | Column, buckets: int = 10) -> Column:
    """Stable bucket 0..buckets-1 from the md5 of the key's text form."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def hash_split(df: DataFrame, key: str, train_share: float = 0.8, buckets: int = 10,
               col_name: str = "split", max_buckets: int = 1_000_000) -> DataFrame:
    """Label each row 'train' or 'test' from a hash of its key.

    The label depends only on the key, so it is the same for any partition
    layout, any executor count and any rerun. ``buckets`` is raised to a
    multiple that expresses the share exactly; a share that needs more than
    ``max_buckets`` is refused.
    """
    share = Fraction(str(train_share))
    buckets = math.lcm(buckets, share.denominator)
    if not 0 <= share <= 1 or buckets > max_buckets:
        raise ValueError(f"train_share {train_share} is no share of at most {max_buckets} buckets")
    cut = int(share * buckets)
    return df.withColumn(col_name, F.when(hash_bucket(key, buckets) < cut, F.lit("train"))
                         .otherwise(F.lit("test")))


# --------------------------------------------------------------------------- fitting

@dataclass(frozen=True)
class LineFit:
    """A fitted line; without two different feature values all but n are None."""
    slope: float | None
    intercept: float | None
    r2: float | None
    n: int
    rmse: float | None

    def predict(self, x: str | Column) -> Column:
        xc = F.col(x) if isinstance(x, str) else x
        return F.lit(self.intercept).cast("double") + F.lit(self.slope).cast("double") * xc.cast("double")


def line_fit_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` as a one-row frame (one pass).

    The training RMSE comes from the same pass: for the least-squares
    line the residual sum of squares is Syy - Sxy^2 / Sxx (centred sums).
    No rows, or a constant feature, give a null line.
    """
    yc, xc = F.col(y), F.col(x)
    sse = F.regr_syy(yc, xc) - F.try_divide(F.regr_sxy(yc, xc) * F.regr_sxy(yc, xc), F.regr_sxx(yc, xc))
    return df.agg(F.regr_slope(yc, xc).alias("slope"),
                  F.regr_intercept(yc, xc).alias("intercept"),
                  F.regr_r2(yc, xc).alias("r2"),
                  F.regr_count(yc, xc).alias("n"),
                  F.sqrt(F.try_divide(F.when(sse.isNotNull(), F.greatest(sse, F.lit(0.0))), F.regr_count(yc, xc))).alias("rmse"))


def fit_line(df: DataFrame, x: str, y: str) -> LineFit:
    """Fit and bring the four numbers of the model to the driver."""
    row = line_fit_frame(df, x, y).first()
    return LineFit(row["slope"], row["intercept"], row["r2"], int(row["n"]), row["rmse"])


def fit_linear(df: DataFrame, features_col: str, label: str, *, max_iter: int = 100,
               reg_param: float = 0.0, elastic_net: float = 0.0, solver: str = "normal") -> LinearRegressionModel:
    """``pyspark.ml`` linear regression (elastic net when ``reg_param > 0``).

    ``normal`` makes one pass for the sums of products and solves on the
    driver (up to 4,096 features). ``l-bfgs`` passes over the rows once per
    iteration; only for it the rows are persisted.
    """
    persist = solver == "l-bfgs"
    train = df.select(features_col, label)
    if persist:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lr = LinearRegression(featuresCol=features_col, labelCol=label, maxIter=max_iter,
                              regParam=reg_param, elasticNetParam=elastic_net, solver=solver)
        return lr.fit(train)
    finally:
        if persist:
            train.unpersist()


def model_frame(spark: SparkSession, model: LinearRegressionModel,
                feature_names: Sequence[str], digits: int | None = None) -> DataFrame:
    """Coefficients, intercept and training RMSE / R2 as a small frame."""
    s = model.summary
    rows = [(n, "coefficient", float(c)) for n, c in zip(feature_names, model.coefficients)]
    rows += [("intercept", "intercept", float(model.intercept)), ("rmse", "metric", float(s.rootMeanSquaredError)),
             ("r2", "metric", float(s.r2)), ("iterations", "metric", float(s.totalIterations))]
    return spark.createDataFrame(rows, "term string, kind string, value double") \
        .withColumn("value", fixed_round("value", digits))


# --------------------------------------------------------------------------- evaluation

def rmse_value(df: DataFrame, label: str, prediction: str) -> float:
    """Root mean squared error (one distributed aggregate, a scalar back)."""
    return float(df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))).first()[0])


def residual_frame(df: DataFrame, label: str, prediction: str, rmse: float,
                   label_alias: str | None = None) -> DataFrame:
    """label, predictedPrice, Residual_Error, Within_RMSE (residual / rmse).

    The divisor is an argument: which RMSE (training or test) it is must be
    chosen by the caller, see ``residual_analysis``.
    """
    err = F.col(label) - F.col(prediction)
    return df.select(F.col(label).alias(label_alias or label),
                     F.col(prediction).alias("predictedPrice"),
                     err.alias("Residual_Error"),
                     (err / F.lit(rmse)).alias("Within_RMSE"))


def rmse_band(c: str | Column = "Within_RMSE") -> Column:
    """1 within one RMSE, 2 within two, 3 beyond."""
    w = F.col(c) if isinstance(c, str) else c
    return (F.when((w <= 1.0) & (w >= -1.0), F.lit(1))
             .when((w <= 2.0) & (w >= -2.0), F.lit(2))
             .otherwise(F.lit(3)))


def residual_bands(residuals: DataFrame, col: str = "Within_RMSE") -> DataFrame:
    """Rows per RMSE band (1, 2 or 3)."""
    return residuals.groupBy(rmse_band(col).alias("RMSE_Multiple")).agg(
        F.count(F.lit(1)).alias("count"))


def residual_histogram(residuals: DataFrame, col: str = "Within_RMSE",
                       width: float = 0.5) -> DataFrame:
    """Histogram source: bucket = floor(value / width), rows per bucket."""
    bucket = F.floor(F.col(col) / F.lit(width)).cast("long")
    return residuals.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count")) \
                    .withColumn("bucket_start", F.col("bucket") * F.lit(width))


def feature_label_corr(df: DataFrame, features: Sequence[str], label: str,
                       digits: int | None = None) -> DataFrame:
    """Pearson correlation of each feature with the label, one scan, long form."""
    one = df.agg(*[fixed_round(F.corr(F.col(f).cast("double"), F.col(label).cast("double")), digits)
                   .alias(f"_{i}") for i, f in enumerate(features)])
    parts = ", ".join(f"{_lit(f)}, `_{i}`" for i, f in enumerate(features))
    return one.selectExpr(f"stack({len(features)}, {parts}) as (feature, corr)")
