"""Queries for the regression workflow (lineitem stands in for housing:
label ``l_extendedprice``; features quantity, discount, tax and the
indexed return flag; rows split by a hash of the order key, so all lines
of an order fall on the same side)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import fixed_round
from quarry.operators import regression as M
from quarry.operators.elastic_net import coordinate_descent, fit_frame, moments
from quarry.operators.models import load_model, save_model
from quarry.plans.registry import fixed_sql, query
from quarry.plans.standins import table
from quarry.session import session_path, session_table
from quarry.sources.sinks import save_table

LABEL, X = "l_extendedprice", "l_quantity"
FEATURES = ["l_quantity", "l_discount", "l_tax", "returnflag_index"]

_SPLIT_SQL = ("CASE WHEN CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 8 "
              "THEN 'train' ELSE 'test' END")

_FIT_CTE = f"""WITH s AS (SELECT *, {_SPLIT_SQL.format(k='l_orderkey')} AS split FROM lineitem),
fit AS (SELECT regr_slope({LABEL}, {X}) AS b, regr_intercept({LABEL}, {X}) AS a,
               regr_r2({LABEL}, {X}) AS r2, regr_count({LABEL}, {X}) AS n
        FROM s WHERE split = 'train'),
scored AS (SELECT s.*, (SELECT a FROM fit) + (SELECT b FROM fit) * {X} AS prediction FROM s),
train_rmse AS (SELECT sqrt(avg(power({LABEL} - prediction, 2))) AS rmse
               FROM scored WHERE split = 'train'),
res AS (SELECT {LABEL} AS price, prediction AS predictedPrice,
               {LABEL} - prediction AS Residual_Error,
               ({LABEL} - prediction) / (SELECT rmse FROM train_rmse) AS Within_RMSE
        FROM scored WHERE split = 'test')"""


def _split_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return M.hash_split(table(spark, sf, "lineitem"), "l_orderkey")


def _fit(spark: SparkSession, sf: str):
    s = _split_lineitem(spark, sf)
    train = s.where(F.col("split") == "train")
    return s, train, M.fit_line(train, X, LABEL)


def _residuals(spark: SparkSession, sf: str, rmse_source: str = "train") -> DataFrame:
    s, train, fit = _fit(spark, sf)
    scored = s.withColumn("prediction", fit.predict(X))
    test = scored.where(F.col("split") == "test")
    # which RMSE divides the residuals is explicit (the two reference
    # notebooks used different ones under the same headline); the training
    # RMSE comes with the fit, the test RMSE needs one more pass
    if rmse_source == "train":
        rmse = fit.rmse
    else:
        rmse = M.rmse_value(scored.where(F.col("split") == rmse_source), LABEL, "prediction")
    return M.residual_frame(test, LABEL, "prediction", rmse, label_alias="price")


@query("index_by_frequency", ops=("M01",), sql="""
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
l AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS DOUBLE) AS brand_index
      FROM c)
SELECT p.p_partkey, p.p_brand, l.brand_index FROM part p JOIN l USING (p_brand)""")
def index_by_frequency(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return M.index_column(p, "p_brand", "brand_index", order="frequencyDesc") \
        .select("p_partkey", "p_brand", "brand_index")


@query("index_alphabetical", ops=("M02",), sql="""
SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS type_index
FROM part""")
def index_alphabetical(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    return M.index_column(p, "p_type", "type_index", order="alphabetAsc") \
        .select("p_partkey", "p_type", "type_index")


_RF_INDEX_CTE = """rf AS (SELECT l_returnflag,
           CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS DOUBLE) AS returnflag_index
           FROM lineitem GROUP BY l_returnflag)"""


def _with_features(df: DataFrame) -> DataFrame:
    indexed = M.index_column(df, "l_returnflag", "returnflag_index", handle_invalid="keep")
    return M.assemble(indexed, FEATURES, "features")


@query("assemble_features", ops=("M03", "M04"), sql=f"""
WITH {_RF_INDEX_CTE}
SELECT l_orderkey, l_linenumber, l_quantity AS f_quantity, l_discount AS f_discount,
       l_tax AS f_tax, returnflag_index AS f_returnflag
FROM lineitem JOIN rf USING (l_returnflag)""")
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *FEATURES[:3])
    v = _with_features(li).select("l_orderkey", "l_linenumber", "features")
    return M.vector_elements(v, "features", ["f_quantity", "f_discount", "f_tax", "f_returnflag"])


@query("hash_split", ops=("M05",), sql=f"""
SELECT o_orderkey, {_SPLIT_SQL.format(k='o_orderkey')} AS split FROM orders""")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return M.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("ols_fit", ops=("M07", "M08"), sql=f"""
{_FIT_CTE}
SELECT {fixed_sql('b', 6)} AS slope, {fixed_sql('a', 6)} AS intercept,
       {fixed_sql('r2', 6)} AS r2, CAST(n AS BIGINT) AS n FROM fit""")
def ols_fit(spark: SparkSession, sf: str) -> DataFrame:
    train = _split_lineitem(spark, sf).where(F.col("split") == "train")
    fit = M.line_fit_frame(train, X, LABEL)
    return fit.select(fixed_round("slope", 6).alias("slope"), fixed_round("intercept", 6).alias("intercept"),
                      fixed_round("r2", 6).alias("r2"), F.col("n").cast("bigint").alias("n"))


@query("regression_metrics", ops=("G14", "M08"), sql=f"""
{_FIT_CTE}
SELECT {fixed_sql('rmse', 4)} AS rmse, {fixed_sql('(SELECT r2 FROM fit)', 6)} AS r2
FROM train_rmse""")
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    train = _split_lineitem(spark, sf).where(F.col("split") == "train")
    fit = M.line_fit_frame(train, X, LABEL)
    return fit.select(fixed_round("rmse", 4).alias("rmse"), fixed_round("r2", 6).alias("r2"))


@query("score_rows", ops=("M09", "M10", "K06"), writes=True, sql=f"""
{_FIT_CTE}
SELECT l_orderkey, l_linenumber, {LABEL} AS price, {fixed_sql('prediction', 4)} AS prediction
FROM scored WHERE split = 'test'""")
def score_rows(spark: SparkSession, sf: str) -> DataFrame:
    s, _, fit = _fit(spark, sf)
    pred = (s.where(F.col("split") == "test")
             .select("l_orderkey", "l_linenumber", F.col(LABEL).alias("price"),
                     fit.predict(X).alias("prediction")))
    name = session_table(spark, "predictions")
    save_table(pred, name)
    spark.read.table(name).createOrReplaceTempView("predictions_view")
    return spark.sql("SELECT l_orderkey, l_linenumber, price, "
                     "CAST(floor(prediction * 10000.0 + 0.5) / 10000.0 AS DOUBLE) AS prediction "
                     "FROM predictions_view")


@query("residuals", ops=("M11", "B09"), sql=f"""
{_FIT_CTE}
SELECT {fixed_sql('price', 4)} AS price, {fixed_sql('predictedPrice', 4)} AS predictedPrice,
       {fixed_sql('Residual_Error', 4)} AS Residual_Error, {fixed_sql('Within_RMSE', 6)} AS Within_RMSE
FROM res""")
def residuals(spark: SparkSession, sf: str) -> DataFrame:
    r = _residuals(spark, sf, rmse_source="train")
    return r.select(*[fixed_round(c, 6 if c == "Within_RMSE" else 4).alias(c) for c in r.columns])


@query("residual_bands", ops=("M12", "G08", "X14"), sql=f"""
{_FIT_CTE}
SELECT CASE WHEN Within_RMSE <= 1.0 AND Within_RMSE >= -1.0 THEN 1
            WHEN Within_RMSE <= 2.0 AND Within_RMSE >= -2.0 THEN 2 ELSE 3 END AS RMSE_Multiple,
       count(*) AS count
FROM res GROUP BY RMSE_Multiple""")
def residual_bands(spark: SparkSession, sf: str) -> DataFrame:
    return M.residual_bands(_residuals(spark, sf))


@query("residual_histogram", ops=("M13",), sql=f"""
{_FIT_CTE}
SELECT CAST(floor(Within_RMSE / 0.5) AS BIGINT) AS bucket, count(*) AS count,
       CAST(CAST(floor(Within_RMSE / 0.5) AS BIGINT) AS DOUBLE) * 0.5 AS bucket_start
FROM res GROUP BY 1""")
def residual_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return M.residual_histogram(_residuals(spark, sf), width=0.5)


@query("feature_label_corr", ops=("M14",), sql="\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, {fixed_sql(f'corr({f}, {LABEL})', 6)} AS corr FROM lineitem"
    for f in FEATURES[:3]))
def feature_label_corr(spark: SparkSession, sf: str) -> DataFrame:
    return M.feature_label_corr(table(spark, sf, "lineitem"), FEATURES[:3], LABEL, digits=6)


# Solver settings of the reference's elastic-net model.
EN_REG, EN_ELASTIC = 0.05, 0.05


# Least squares in SQL by successive orthogonalisation: z_k is feature k less
# its mean and its parts along z_1 .. z_{k-1}, all taken from the training rows.
_F = ["l_quantity", "l_discount", "l_tax", "returnflag_index"]


def _multi_cte() -> str:
    def z(k):
        parts = "".join(f" - coalesce(c{j}.s{k}{j}, 0) * z{j}" for j in range(1, k))
        return f"{_F[k - 1]} - m.m{k}{parts}"

    steps = [f"""WITH {_RF_INDEX_CTE},
s AS (SELECT l_orderkey, l_linenumber, {LABEL} AS y, l_quantity, l_discount, l_tax, returnflag_index,
      {_SPLIT_SQL.format(k='l_orderkey')} AS split FROM lineitem JOIN rf USING (l_returnflag)),
m AS (SELECT {', '.join(f'avg({f}) AS m{k}' for k, f in enumerate(_F, 1))}, avg(y) AS my, count(*) AS n FROM s WHERE split = 'train')"""]
    source = "s"
    for k in range(1, 5):
        tables = ", ".join(["m", *(f"c{j}" for j in range(1, k))])
        steps.append(f"z{k}t AS (SELECT t.*, {z(k)} AS z{k} FROM {source} t, {tables})")
        later = "".join(f", regr_slope({_F[i - 1]}, z{k}) AS s{i}{k}" for i in range(k + 1, 5))
        steps.append(f"c{k} AS (SELECT regr_slope(y, z{k}) AS g{k}{later} FROM z{k}t WHERE split = 'train')")
        source = f"z{k}t"
    steps.append("""scored AS (SELECT t.*, my + g1 * z1 + g2 * z2 + g3 * z3 + g4 * z4 AS prediction FROM z4t t, m, c1, c2, c3, c4),
b AS (SELECT *, g1 - s21 * b2 - s31 * b3 - s41 * b4 AS b1 FROM (SELECT *, g2 - s32 * b3 - s42 * b4 AS b2 FROM
      (SELECT *, g3 - s43 * b4 AS b3 FROM (SELECT *, g4 AS b4 FROM c1, c2, c3, c4)))),
quality AS (SELECT sqrt(avg((y - prediction) ** 2)) AS rmse, 1 - sum((y - prediction) ** 2) / sum((y - my) ** 2) AS r2
            FROM scored, m WHERE split = 'train')""")
    return ",\n".join(steps)


def _indexed_lines(spark: SparkSession, sf: str):
    """(split rows, fitted pipeline that indexes and assembles; the return flag has three values)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", LABEL, *FEATURES[:3])
    split = M.hash_split(li, "l_orderkey")
    return split, M.feature_pipeline(["l_returnflag"], FEATURES[:3]).fit(split)


def _multi(spark: SparkSession, sf: str, **options):
    """(split rows with their features, model of the training rows)."""
    split, indexed = _indexed_lines(spark, sf)
    data = indexed.transform(split)
    return data, M.fit_linear(data.where(F.col("split") == "train"), "features", LABEL, **options)


@query("ols_fit_multi", ops=("M04", "M07", "M08"), sql=f"""
{_multi_cte()}
SELECT term, kind, {fixed_sql('value', 3)} AS value FROM (
  SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'returnflag_index', 'intercept', 'rmse', 'r2']) AS term,
         unnest(['coefficient', 'coefficient', 'coefficient', 'coefficient', 'intercept', 'metric', 'metric']) AS kind,
         unnest([b1, b2, b3, b4, my - b1 * m1 - b2 * m2 - b3 * m3 - b4 * m4, rmse, r2]) AS value FROM b, m, quality)""")
def ols_fit_multi(spark: SparkSession, sf: str) -> DataFrame:
    _, model = _multi(spark, sf)
    return M.model_frame(spark, model, FEATURES, digits=3).where("term <> 'iterations'")


@query("score_rows_multi", ops=("M04", "M09", "M10", "K06"), writes=True, sql=f"""
{_multi_cte()}
SELECT l_orderkey, l_linenumber, y AS price, {fixed_sql('prediction', 1)} AS prediction FROM scored WHERE split = 'test'""")
def score_rows_multi(spark: SparkSession, sf: str) -> DataFrame:
    data, model = _multi(spark, sf)
    scored = model.transform(data.where(F.col("split") == "test"))
    name = session_table(spark, "predictions_multi")
    save_table(scored.select("l_orderkey", "l_linenumber", F.col(LABEL).alias("price"), "prediction"), name)
    return spark.read.table(name).withColumn("prediction", fixed_round("prediction", 1))


# (name of the fit, reg, alpha): the reference's, and one that leaves out most terms
EN_FITS = [("reference", EN_REG, EN_ELASTIC), ("strong", 60.0, 0.9)]
#: Sweeps of the oracle; the descent itself stops when nothing changes any more, long before.
EN_SWEEPS = 60


def _elastic_sql() -> str:
    """The same descent as a recursive query: one row per fit and sweep."""
    ks = range(1, 5)
    pair = lambda i, j: f"g{min(i, j)}{max(i, j)}"
    stats = [f"avg({f}) AS m{k}, stddev_pop({f}) AS s{k}, covar_pop({f}, y) AS cy{k}" for k, f in zip(ks, _F)]
    stats += [f"covar_pop({_F[i - 1]}, {_F[j - 1]}) AS {pair(i, j)}" for i in ks for j in ks if i <= j]

    def rest(k, upto):  # target less the other terms, those before k already moved on
        return f"cy{k} / (s{k} * sy)" + "".join(
            f" - {pair(k, j)} / (s{k} * s{j}) * {'n' if j < upto else 'b'}{j}" for j in ks if j != k)

    soft = lambda x: f"sign({x}) * greatest(abs({x}) - l1, 0)"
    step = "cd JOIN pen USING (fit), m"
    for k in ks:
        x = rest(k, k)
        step = f"(SELECT *, ({soft(x)}) / ({pair(k, k)} / (s{k} * s{k}) + l2) AS n{k} FROM {step})"
    slope = lambda k: f"(cy{k} / (s{k} * sy) - l2 * b{k}" + "".join(f" - {pair(k, j)} / (s{k} * s{j}) * b{j}" for j in ks) + ")"
    gap = lambda k: f"CASE WHEN b{k} <> 0 THEN abs({slope(k)} - l1 * sign(b{k})) ELSE greatest(abs({slope(k)}) - l1, 0) END"
    error = "vy - 2 * (" + " + ".join(f"w{k} * cy{k}" for k in ks) + ") + " + " + ".join(f"w{i} * w{j} * {pair(i, j)}" for i in ks for j in ks)
    fits = ", ".join(f"('{n}', {r}::DOUBLE, {a}::DOUBLE)" for n, r, a in EN_FITS)
    return f"""WITH RECURSIVE {_multi_cte().split('WITH ', 1)[1].split('s AS (', 1)[0]}
s AS (SELECT {LABEL} AS y, l_quantity, l_discount, l_tax, returnflag_index,
      {_SPLIT_SQL.format(k='l_orderkey')} AS split FROM lineitem JOIN rf USING (l_returnflag)),
m AS (SELECT {', '.join(stats)}, avg(y) AS my, stddev_pop(y) AS sy, var_pop(y) AS vy FROM s WHERE split = 'train'),
pen AS (SELECT fit, reg / sy * alpha AS l1, reg / sy * (1 - alpha) AS l2 FROM (VALUES {fits}) t(fit, reg, alpha), m),
cd AS (SELECT fit, 0 AS sweep, {', '.join(f'0.0::DOUBLE AS b{k}' for k in ks)} FROM pen
  UNION ALL SELECT fit, sweep + 1, {', '.join(f'n{k}' for k in ks)} FROM {step} WHERE sweep < {EN_SWEEPS}),
done AS (SELECT *, {', '.join(f'b{k} * sy / s{k} AS w{k}, {gap(k)} AS gap{k}' for k in ks)} FROM cd JOIN pen USING (fit), m WHERE sweep = {EN_SWEEPS}),
full_fit AS (SELECT *, my - {' - '.join(f'w{k} * m{k}' for k in ks)} AS icept, {error} AS mse FROM done)
SELECT fit, term, kind, CASE WHEN term = 'r2' THEN {fixed_sql('value', 9)} ELSE {fixed_sql('value', 3)} END AS value,
       {fixed_sql('gap', 6)} AS gap FROM (
  SELECT fit, unnest([{', '.join(f"'{f}'" for f in _F)}, 'intercept', 'rmse', 'r2']) AS term,
         unnest(['coefficient', 'coefficient', 'coefficient', 'coefficient', 'intercept', 'metric', 'metric']) AS kind,
         unnest([w1, w2, w3, w4, icept, sqrt(mse), 1 - mse / vy]) AS value,
         unnest([gap1, gap2, gap3, gap4, NULL, NULL, NULL]) AS gap FROM full_fit)"""


@query("elastic_net_fit", ops=("M06", "M04", "M08"), sql=_elastic_sql())
def elastic_net_fit(spark: SparkSession, sf: str) -> DataFrame:
    split, indexed = _indexed_lines(spark, sf)
    train = indexed.transform(split).where(F.col("split") == "train").withColumnRenamed("l_returnflag_index", "returnflag_index")
    sums = moments(train, FEATURES, LABEL)  # one pass for all fits
    return fit_frame(spark, {name: coordinate_descent(sums, reg, alpha) for name, reg, alpha in EN_FITS})


@query("score_reloaded", ops=("M04", "M09", "M10"), writes=True, sql=f"""
{_multi_cte()}
SELECT l_orderkey, l_linenumber, y AS price, {fixed_sql('prediction', 1)} AS prediction FROM scored WHERE split = 'test'""")
def score_reloaded(spark: SparkSession, sf: str) -> DataFrame:
    split, indexed = _indexed_lines(spark, sf)
    train = split.where(F.col("split") == "train")
    # the index is fitted on all rows, the line on the training rows; both stages are saved as one pipeline
    line = M.fit_linear(indexed.transform(train), "features", LABEL)
    root = session_path(spark, "models")
    version = save_model(PipelineModel([*indexed.stages, line]), spark, root, "price")
    model = load_model(spark.newSession(), root, "price", version)
    scored = model.transform(split.where(F.col("split") == "test"))
    return scored.select("l_orderkey", "l_linenumber", F.col(LABEL).alias("price"), fixed_round("prediction", 1).alias("prediction"))
