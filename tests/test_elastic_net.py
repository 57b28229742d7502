"""Coordinate descent: optimality, pyspark's fit, least squares, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.operators import regression as M
from quarry.operators.elastic_net import coordinate_descent, fit_elastic_net, moments
from quarry.plans import q_regression as Q

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) * [1, 10, 0.1, 5]
    x[:, 1] += 8 * x[:, 0]  # correlated
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 0.01 * x[:, 3] + rng.normal(size=400) + 7
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double")


@pytest.mark.parametrize("reg,alpha", [(0.0, 0.0), (0.05, 0.05), (0.5, 0.5), (0.4, 1.0), (1.0, 0.0), (100.0, 1.0)])
def test_equals_pysparks_fit(rows, reg, alpha):
    fit = fit_elastic_net(rows, NAMES, "y", reg, alpha)
    theirs = M.fit_linear(M.assemble(rows, NAMES), "features", "y", max_iter=1000, reg_param=reg, elastic_net=alpha)
    assert np.allclose(fit.coefficients, theirs.coefficients.toArray(), atol=2e-4)
    assert np.isclose(fit.intercept, theirs.intercept, atol=2e-3)
    assert np.isclose(fit.rmse, theirs.summary.rootMeanSquaredError, rtol=1e-6) and np.isclose(fit.r2, theirs.summary.r2, atol=1e-6)
    assert fit.gaps.max() < 1e-9


def test_the_penalty_leaves_terms_out_and_the_condition_notices(rows):
    m = moments(rows, NAMES, "y")
    strong = coordinate_descent(m, 0.6, 1.0)
    assert 0 < np.count_nonzero(strong.coefficients) < 4
    assert np.count_nonzero(coordinate_descent(m, 0.6, 0.0).coefficients) == 4
    assert np.count_nonzero(coordinate_descent(m, 1e6, 1.0).coefficients) == 0
    assert coordinate_descent(m, 0.6, 1.0, max_sweeps=1).gaps.max() > 1e-6  # not yet at the optimum


def test_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (4.0, 5.0, 8.0), (None, 5.0, 1.0)], "x double, `k.c` double, y double")
    fit = fit_elastic_net(df, ["x", "k.c"], "y", 0.0, 0.5)
    assert np.allclose(fit.coefficients, [2, 0]) and np.isclose(fit.intercept, 0) and np.isclose(fit.r2, 1)
    flat = fit_elastic_net(df.withColumn("y", F.lit(3.0)), ["x"], "y", 0.1, 0.5)
    assert flat.coefficients[0] == 0 and flat.intercept == 3 and flat.r2 is None
    with pytest.raises(ValueError):
        fit_elastic_net(df.limit(0), ["x"], "y", 0.1, 0.5)
    with pytest.raises(ValueError):
        fit_elastic_net(df, ["x"], "y", 0.1, 2.0)
    with pytest.raises(ValueError):
        moments(df, [f"f{i}" for i in range(65)], "y")


def test_the_oracle_depends_on_the_penalty(spark, monkeypatch):
    """The query's row turns red when its penalties are set to 0."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF_SMALL}/lineitem.parquet'")
    expect = {(f, t): v for f, t, _, v, _ in con.execute(E.oracle_sql()["elastic_net_fit"]).fetchall()}
    got = lambda: {(r.fit, r.term): r.value for r in E.queries()["elastic_net_fit"](spark, SF_SMALL).collect()}
    assert got() == expect
    assert any(v == 0.0 for (f, t), v in expect.items() if f == "strong" and t.startswith("l_"))
    monkeypatch.setattr(Q, "EN_FITS", [(n, 0.0, a) for n, _, a in Q.EN_FITS])
    free = got()
    assert all(any(free[f, t] != expect[f, t] for t in Q.FEATURES) for f in ("reference", "strong"))
