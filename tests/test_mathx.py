import math

import numpy as np
from pyspark.sql import functions as F

from trailfeat.functions.mathx import MAX_DOUBLE, nan_to_num, np_log1p

VALS = [-5.0, -1.0, -0.5, 0.0, 3.0, float("nan"), float("inf"), float("-inf")]


def _same(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) < 1e-12


def test_np_log1p_matches_numpy(spark):
    df = spark.createDataFrame([(v,) for v in VALS], "v double")
    got = [r[0] for r in df.select(np_log1p("v")).collect()]
    with np.errstate(all="ignore"):
        exp = [float(np.log1p(v)) for v in VALS]
    assert all(_same(a, b) for a, b in zip(got, exp)), (got, exp)


def test_nan_to_num_matches_numpy(spark):
    df = spark.createDataFrame([(v,) for v in VALS], "v double")
    got = [r[0] for r in df.select(nan_to_num("v")).collect()]
    exp = [float(np.nan_to_num(v)) for v in VALS]
    assert got == exp
    assert MAX_DOUBLE == float(np.finfo(np.float64).max)


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.select(np_log1p("v"), nan_to_num("v")).first() == (None, None)
