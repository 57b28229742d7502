"""Noise per row: layout, independence, shape."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from quarry.functions.noise import normal, uniform


def test_same_numbers_under_any_layout(spark):
    df = spark.range(5000)
    draw = lambda d: sorted(tuple(r) for r in d.select("id", uniform(3, "id").alias("u"), normal(3, "id").alias("z")).collect())
    assert draw(df.repartition(1)) == draw(df.repartition(13, "id")) == draw(df.orderBy(F.desc("id")))


def test_by_hand_and_null(spark):
    got = spark.createDataFrame([(5,), (None,)], "k long").select(uniform(9, "k", -1, 3).alias("u"), normal(9, "k", 10, 2).alias("z")).collect()
    h = hashlib.md5(b"9:5").hexdigest()
    u, v = ((int(x, 16) + 0.5) / 2**52 for x in (h[:13], h[13:26]))
    assert math.isclose(got[0].u, -1 + 4 * u) and math.isclose(got[0].z, 10 + 2 * math.sqrt(-2 * math.log(u)) * math.cos(2 * math.pi * v))
    assert got[1].u is None and got[1].z is None


def test_shape(spark):
    x = np.array(spark.range(20000).select(uniform(1, "id"), normal(1, "id"), uniform(2, "id")).collect())
    assert abs(x[:, 0].mean() - 0.5) < 0.01 and x[:, 0].min() > 0 and x[:, 0].max() < 1
    assert abs(x[:, 1].mean()) < 0.03 and abs(x[:, 1].std() - 1) < 0.03
    assert abs(np.corrcoef(x[:, 0], x[:, 2])[0, 1]) < 0.03  # another seed, other numbers
