"""Array form and long form give the same 70 features; the long form's
medians are exact for a trajectory spread over many blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trailfeat.operators import features as FT
from trailfeat.operators import longform as LF
from trailfeat.operators.parse import explode_points
from trailfeat.sources import events as E


def _compare(a, b):
    a, b = a.toPandas().set_index("traj_id").sort_index(), b.toPandas().set_index("traj_id").sort_index()
    assert list(a.index) == list(b.index)
    for c in FT.FEATURES:
        x, y = a[c].astype(float).values, b[c].astype(float).values
        assert np.isclose(x, y, rtol=1e-9, atol=1e-9, equal_nan=True).all(), c


def test_array_equals_long_on_weeks(spark):
    tr = E.calendar_trajectories(spark, SF_SMALL).cache()
    arr = FT.feature_matrix(tr)
    pts = explode_points(tr, keep=("traj_id", "aim", "label")).select(
        "traj_id", "pos", "x", "y", "t", F.col("aim.ax").alias("ax"), F.col("aim.ay").alias("ay"), "label")
    _compare(arr, LF.feature_matrix_long(LF.step_series(LF.lag_points(pts))))


def test_long_form_hot_trajectory(spark):
    rnd = np.random.default_rng(3)
    n = 3001
    xs, ys, ts = rnd.normal(size=n).cumsum(), rnd.normal(size=n).cumsum(), np.cumsum(rnd.integers(0, 3, n))
    rows = [("hot", i, float(xs[i]), float(ys[i]), float(ts[i]), 1.0, 2.0, "1") for i in range(n)]
    rows += [("small", 0, 1.0, 1.0, 1.0, 0.0, 0.0, "0")]
    schema = "traj_id string, pos long, x double, y double, t double, ax double, ay double, label string"
    pts = spark.createDataFrame(rows, schema)
    lf = LF.feature_matrix_long(LF.step_series(LF.lag_points(pts, rows_per_block=200)), heavy=LF.heavy_keys(pts, rows_per_block=200))
    arr_in = pts.groupBy("traj_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "x", "y", "t"))).alias("p"),
        F.first("ax").alias("ax"), F.first("ay").alias("ay"), F.first("label").alias("label"))
    arr_in = arr_in.select("traj_id", F.transform("p", lambda q: F.struct(q.x.alias("x"), q.y.alias("y"), q.t.alias("t"))).alias("points"),
                           F.struct("ax", "ay").alias("aim"), "label")
    _compare(FT.feature_matrix(arr_in), lf)
    med = lf.filter("traj_id = 'hot'").first()
    assert abs(med.x_median - float(np.median(xs))) < 1e-9


def test_median_with_massive_ties(spark):
    """Hot trajectories whose values are mostly one repeated number keep the exact
    median, with a coarse bracket too, and NaN makes it NaN."""
    n = 4001
    xs = [5.0] * 3000 + [float(i) for i in range(1001)]
    ys = [float(i % 7) for i in range(n - 1)] + [float("nan")]
    schema = "traj_id string, pos long, x double, y double, t double, ax double, ay double, label string"
    rows = [("hot", i, xs[i], ys[i], float(i * i % 1013), 0.0, 0.0, "1") for i in range(n)]
    rows += [("even", i, float(i % 2), 1.0, float(i), 0.0, 0.0, "1") for i in range(600)]
    pts = spark.createDataFrame(rows, schema)
    steps = LF.step_series(LF.lag_points(pts, rows_per_block=400))
    got = {r.traj_id: r for r in LF.trajectory_summaries(steps, heavy=LF.heavy_keys(pts, rows_per_block=400)).collect()}
    assert got["hot"].x_median == float(np.median(xs)) and np.isnan(got["hot"].y_median)
    assert got["hot"].t_median == float(np.median([i * i % 1013 for i in range(n)])) and got["hot"].point_count == n
    assert got["even"].x_median == 0.5
    rough = LF.heavy_medians(steps.where("traj_id = 'hot'"), ["x", "t", "log_speed"]).first()
    assert rough["x__heavy"] == got["hot"].x_median and rough["t__heavy"] == got["hot"].t_median


def test_long_trajectory_keeps_every_step(spark):
    n = 10_000
    pts = spark.range(n).select(F.lit(1).alias("traj_id"), F.col("id").alias("pos"), F.col("id").cast("double").alias("x"),
                                F.lit(1.0).alias("y"), (2.0 * F.col("id")).alias("t"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay"))
    steps = LF.step_series(LF.lag_points(pts, rows_per_block=300)).cache()
    for name in ("step_distance_x", "time_delta", "log_speed"):
        rows = LF.series_rows(steps, name)
        assert rows.count() == n - 1 and rows.select("i").distinct().count() == n - 1
    assert LF.series_rows(steps, "log_speed_diff").count() == n - 2
    assert LF.series_rows(steps, "step_distance_x").where("v <> 1").count() == 0
    assert LF.continuity(steps).first().cx == (n - 1) / n


def test_long_series_equal_array_series_on_short_trajectories(spark):
    """Series, slices, linear forms, counts and offsets on the micro fixtures (one to a few points)."""
    from test_micro_features import LINES
    from trailfeat.functions import series as S
    from trailfeat.functions import stats as A
    from trailfeat.operators.parse import good, parse_trajectories
    tr = good(parse_trajectories(spark.createDataFrame([(l,) for l in LINES.values()], "value string"))).cache()
    pts = explode_points(tr, keep=("traj_id", "aim", "label")).select(
        "traj_id", "pos", "x", "y", "t", F.col("aim.ax").alias("ax"), F.col("aim.ay").alias("ay"), "label")
    steps = LF.step_series(LF.lag_points(pts, rows_per_block=2)).cache()
    arr = FT.with_series(tr)

    def rows(df):
        return sorted(map(repr, (tuple(0.0 if v == 0 else v for v in r) for r in df.collect())))

    for name in ("time_delta", "log_speed", "log_accel", "log_angle", "log_speed_diff", "log_accel_diff", "log_angle_diff"):
        want = arr.select("traj_id", F.posexplode(name).alias("i", "v")).select("traj_id", F.col("i").cast("long"), "v")
        assert rows(LF.series_rows(steps, name)) == rows(want), name
    want = None
    for name in LF.SLICED_SERIES:
        h = arr.select("traj_id", S.head_mid_tail(name).alias("h"))
        for p in ("head", "mid", "tail"):
            one = h.select("traj_id", F.lit(name).alias("series"), F.lit(p).alias("part"), F.posexplode(f"h.{p}").alias("i", "v"))
            want = one if want is None else want.unionByName(one)
    assert rows(LF.head_mid_tail_rows(steps)) == rows(want.withColumn("i", F.col("i").cast("long")))
    lin = arr.select("traj_id", S.linear_speed_accel("xs", "ts").alias("l"))
    want = lin.select("traj_id", F.lit("speed").alias("kind"), F.posexplode("l.speed").alias("i", "v")).unionByName(
        lin.select("traj_id", F.lit("accel").alias("kind"), F.posexplode("l.accel").alias("i", "v")))
    assert rows(LF.linear_rows(steps).select("traj_id", "kind", "i", "v")) == rows(want)
    assert rows(LF.continuity(steps)) == rows(arr.select(
        "traj_id", A.continuity("xs"), A.continuity("ys"), A.continuity("ts")))
    assert rows(LF.final_offset(pts)) == rows(arr.select("traj_id", A.final_offset("xs", "ys", "aim").alias("o")).select("traj_id", "o.*"))
    assert rows(LF.net_displacement(pts)) == rows(arr.select("traj_id", A.net_displacement("xs", "ys", "ts").alias("o")).select("traj_id", "o.*"))
    assert rows(LF.aim_angle(pts)) == rows(arr.select("traj_id", A.aim_angle("xs", "ys", "aim")))


def test_bad_trajectories_are_named(spark):
    """Varying constants, null coordinates and targets: one row each, with a reason, and strict refusal."""
    rows = [("v", 0, 1.0, 0.0, "1"), ("v", 1, 2.0, 0.0, "1"), ("v", 2, 3.0, 0.0, "0"), ("n", 0, None, 0.0, "1"),
            ("n", 1, 2.0, 0.0, "1"), ("a", 0, 1.0, None, "1"), ("a", 1, 1.0, None, "1"), ("ok", 0, 1.0, 0.0, None),
            ("w", 0, 1.0, 0.0, "1"), ("w", 1, 1.0, 2.0, "1")]
    pts = spark.createDataFrame(rows, "traj_id string, pos long, x double, ax double, label string").select(
        "*", F.lit(0.0).alias("y"), F.col("pos").cast("double").alias("t"), F.lit(0.0).alias("ay"))
    steps = LF.step_series(LF.lag_points(pts))
    got = {r.traj_id: r for r in LF.feature_matrix_long(steps, with_reason=True).collect()}
    assert {k: r.reason for k, r in got.items()} == {"v": "varying_constants", "n": "bad_point", "a": "bad_target",
                                                     "ok": None, "w": "varying_constants"}
    assert got["v"].point_count == 3 and got["v"].x_median == 2.0
    with pytest.raises(Exception, match="bad trajectory"):
        LF.feature_matrix_long(steps).collect()


def test_point_table_ordered_by_time_without_pos(spark):
    """A raw point table (no position column) ordered by a time column."""
    rows = [("a", 30.0, 2.0, 1.0, 7.0), ("a", 10.0, 0.0, 0.0, 7.0), ("a", 20.0, 1.0, 3.0, 7.0),
            ("b", 5.0, 4.0, 4.0, 1.0)]
    pts = spark.createDataFrame(rows, "traj_id string, ts double, x double, y double, ax double") \
        .withColumn("t", F.col("ts")).withColumn("ay", F.lit(0.0)).withColumn("label", F.lit("1"))
    lf = LF.feature_matrix_long(LF.step_series(LF.lag_points(pts, order=("ts",))))
    a = lf.filter("traj_id = 'a'").first()
    assert a.point_count == 3 and a.x_first == 0.0 and a.x_last == 2.0 and a.t_first == 10.0
    assert lf.filter("traj_id = 'b'").first().point_count == 1


def test_long_equals_array_on_micro_fixtures(spark):
    """Includes +Inf speeds (dt = -1) and NaN (dt < -1, steps of -1)."""
    from pyspark.sql import functions as F
    from test_micro_features import LINES
    from trailfeat.operators.parse import good, parse_trajectories
    df = spark.createDataFrame([(l,) for l in LINES.values()], "value string")
    tr = good(parse_trajectories(df))
    pts = explode_points(tr, keep=("traj_id", "aim", "label")).select(
        "traj_id", "pos", "x", "y", "t", F.col("aim.ax").alias("ax"), F.col("aim.ay").alias("ay"), "label")
    _compare(FT.feature_matrix(tr),
             LF.feature_matrix_long(LF.step_series(LF.lag_points(pts, rows_per_block=2)), heavy=LF.heavy_keys(pts, rows_per_block=2)))
