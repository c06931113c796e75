"""Counting selection against NumPy's median."""
import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailfeat.operators.median import counting_medians, first_range

SCHEMA = "g string, v double"


def medians(spark, groups, **kw):
    rows = [(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs]
    found = counting_medians(spark.createDataFrame(rows, SCHEMA).repartition(5), ["g"], **kw)
    return {r.g: (r.n, r.median) for r in found.collect()}


def plain(vs):
    kept = sorted(v for v in vs if v is not None and not np.isnan(v))
    n = len(kept)
    return n, (kept[(n - 1) // 2] + kept[n // 2]) / 2


@pytest.mark.parametrize("parts", [64, 4096])
def test_odd_values(spark, parts):
    inf, tiny = float("inf"), 5e-324
    groups = {"one": [3.5], "even": [1.0, 2.0], "ties": [5.0] * 301 + [float(i) for i in range(100)], "zero": [-0.0, 0.0, 0.0, -0.0],
              "signs": [-3.0, -2.5, 2.5, 3.0], "inf": [inf, inf, 1.0], "both": [-inf, 7.0, inf], "tiny": [tiny, 2 * tiny, 3 * tiny, -tiny, 0.0],
              "huge": [1e308, 1.7e308, -1.7e308, 1e-308], "holes": [None, float("nan"), 4.0, None, 6.0],
              "close": [1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 0), 1.0 + 1e-15, 1.0 + 1e-14],
              "powers": [2.0 ** k for k in range(-60, 61)] + [-(2.0 ** k) for k in range(0, 50, 2)],
              "outlier": [1.0 + k * 1e-12 for k in range(200)] + [1.4] * 3}
    got = medians(spark, groups, parts=parts)
    assert got == {g: plain(vs) for g, vs in groups.items()}
    assert medians(spark, {"none": [None, float("nan")]}) == {}


def test_random_groups(spark):
    rng = np.random.default_rng(2)
    groups = {f"g{k}": (rng.normal(size=rng.integers(1, 400)) * 10.0 ** rng.integers(-9, 9)).tolist() for k in range(40)}
    groups["wide"] = np.exp(rng.normal(size=3000) * 100).tolist()
    assert medians(spark, groups, parts=16) == {g: plain(vs) for g, vs in groups.items()}


def test_first_ranges_ascend_with_the_values(spark):
    rng = np.random.default_rng(4)
    vs = np.concatenate([np.exp(rng.normal(size=2000) * 200) * rng.choice([-1, 1], 2000), [0.0, -0.0, 5e-324, -5e-324, 1.8e308, np.inf, -np.inf],
                         2.0 ** np.arange(-1074, 1024, 7), -(2.0 ** np.arange(-1074, 1024, 5))])
    vs = vs[~np.isnan(vs)]
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in np.sort(vs)], "v double").select(F.expr(first_range("v"))).collect()]
    assert got == sorted(got)


def test_aggregates_hold_no_values(spark):
    """No percentile, collected value or sort of all rows: counts by range only."""
    plan = counting_medians(spark.range(1000).selectExpr("'a' as g", "double(id) as v"), ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "Window" not in plan


def test_three_million_values_of_one_key_in_a_small_heap():
    """A key with 3 million different values in each of three series, in a JVM of 512 MB."""
    code = textwrap.dedent("""
        from pyspark.sql import SparkSession
        from trailfeat.operators.median import counting_medians
        spark = (SparkSession.builder.master("local[2]").config("spark.driver.memory", "512m").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        n = 3_000_000
        rows = spark.range(n).selectExpr("'hot' as traj_id",
            "inline(array(named_struct('sid', 0, 'v', double(id * 7919 % 3000000)), named_struct('sid', 1, 'v', log(id + 1)), named_struct('sid', 2, 'v', sqrt(id) - 900)))")
        got = {r.sid: (r.n, r["median"]) for r in counting_medians(rows, ["traj_id", "sid"]).collect()}
        import math
        assert got[0] == (n, (n - 1) / 2), got
        assert got[1][0] == n and abs(got[1][1] - (math.log(n / 2) + math.log(n / 2 + 1)) / 2) < 1e-12
        assert abs(got[2][1] - (math.sqrt(n / 2 - 1) + math.sqrt(n / 2)) / 2 + 900) < 1e-9
        print("right")
    """)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=400,
                          env=os.environ | {"PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"})
    assert "right" in done.stdout, done.stderr[-2000:]
