"""Hand-derived expectations for tiny trajectories (see FIXTURES.md section 3)."""

import math

import pytest

from trailfeat.functions.mathx import MAX_DOUBLE
from trailfeat.operators.features import FEATURES, feature_matrix, with_series
from trailfeat.operators.parse import good, parse_trajectories

LINES = {
    "A": "A 0,0,0;3,4,1;7,5,3; 10,10 1",
    "B": "B 0,0,0;3,4,0;7,5,2; -5,-5 1",
    "C": "C 10,5,0;8,5,1;9,4,2; 0,0 0",
    "D": "D 0,0,5;1,1,4;2,2,6; -1,-1 1",
    "E": "E 2,1,0;5,1,2; 0,0 1",
    "F": "F 4,6,100; 1,2 1",
    "G": "G 0,0,9;1,1,4;2,2,6; -1,-1 1",
}
NAN, INF = float("nan"), float("inf")
SERIES = {   # dt, speed, accel, angle, aim
    "A": ([1, 2], [0.693147, 0.510826], [-0.166558, -0.685956], [0.223144, -0.916291], [4.242641, 7.071068]),
    "B": ([0.0001, 2], [1.386194, 0.510826], [0.869600, -0.685956], [0.223144, -0.916291], [16.970563, 14.142136]),
    "C": ([1, 1], [0.405465, 0], [-0.352779, -0.693147], [NAN, -INF], [12.727922, 5.656854]),
    "D": ([-1, 2], [INF, -0.405465], [INF, -1.618588], [0, 0], [4.242641, 4.242641]),
    "E": ([2], [0.287682], [-0.845769], [-1.386294], [7.071068, 1.414214]),
    "F": ([0.0001], [0], [0], [0], [3.605551, 6.403124]),
    "G": ([-5, 2], [NAN, -0.405465], [NAN, -1.618588], [0, 0], [4.242641, 4.242641]),
}
SCALARS = {  # backtracks, final_dis, aim_angle (guarded), x_std
    "A": (0, 5.830952, 0.0, 2.867442), "B": (0, 15.620499, 0.0, 2.867442),
    "C": (1, 9.848858, -0.606136, 0.816497), "D": (0, 4.242641, 0.0, 0.816497),
    "E": (0, 5.099020, -0.405465, 1.5), "F": (0, 5.0, 0.223144, 0.0),
    "G": (0, 4.242641, 0.0, 0.816497),
}


def close(a, b, tol=1e-6):
    if isinstance(b, float) and math.isnan(b):
        return math.isnan(a)
    if isinstance(b, float) and math.isinf(b):
        return a == b
    return abs(a - b) <= tol


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(l,) for l in LINES.values()], "value string")
    return good(parse_trajectories(df))


def test_series(parsed):
    rows = {r.traj_id: r for r in with_series(parsed).collect()}
    for k, (dt, sp, ac, an, aim) in SERIES.items():
        r = rows[k]
        for got, exp in ((r.time_delta, dt), (r.log_speed, sp), (r.log_accel, ac),
                         (r.log_angle, an), (r.aim_distance, aim)):
            assert len(got) == len(exp) and all(close(a, float(b)) for a, b in zip(got, exp)), (k, got, exp)


def test_scalar_features(parsed):
    rows = {r.traj_id: r for r in feature_matrix(parsed).collect()}
    for k, (back, dis, ang, xstd) in SCALARS.items():
        r = rows[k]
        assert r.backtrack_count == back and close(r.final_dis, dis)
        assert close(r.aim_angle, ang) and close(r.x_std, xstd), k
    assert close(rows["A"].log_speed_mean, 0.601986)
    assert rows["D"].log_speed_mean == MAX_DOUBLE          # +Inf guarded
    assert rows["G"].log_speed_mean == 0.0                 # NaN guarded
    assert all(rows["C"][f"log_angle_{s}"] == 0.0 for s in ("mean", "median", "max", "min"))
    for s in ("mean", "median", "max", "min"):
        assert rows["E"][f"log_speed_diff_{s}"] == 0.0     # two points: diffs are v - v
    f = rows["F"]                                          # one point
    assert f.point_count == 1 and close(f.time_delta_mean, 0.0001) and close(f.time_delta_std, 0.0)
    assert f.log_speed_mean == 0.0 and f.log_angle_diff_max == 0.0


def test_feature_layout(parsed):
    fm = feature_matrix(parsed)
    assert fm.columns == ["traj_id"] + FEATURES + ["label"]
    assert len(FEATURES) == 70


def test_head_mid_tail_slices(spark):
    from pyspark.sql import functions as F
    from trailfeat.functions.series import head_mid_tail
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0, 5.0]), (3, []), (4, [float("nan"), 7.0, 8.0, 9.0])]
    df = spark.createDataFrame(rows, "k int, a array<double>")
    got = {r.k: r.h for r in df.select("k", head_mid_tail("a").alias("h")).collect()}
    # two values repeat 6 times: [1,2,1,2,...] (12 long), mid = 6
    assert (got[1].head, got[1].mid, got[1].tail) == ([1.0, 2.0, 1.0], [1.0, 2.0, 1.0], [2.0, 1.0, 2.0])
    # five values: mid = 2 -> [0:3]
    assert (got[2].head, got[2].mid, got[2].tail) == ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [3.0, 4.0, 5.0])
    # empty -> [0] repeated
    assert got[3].head == got[3].mid == got[3].tail == [0.0, 0.0, 0.0]
    # NaN -> 0 after nan_to_num; four values: mid = 2
    assert (got[4].head, got[4].tail) == ([0.0, 7.0, 8.0], [7.0, 8.0, 9.0])
