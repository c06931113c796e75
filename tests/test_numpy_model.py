"""Randomised check of the 70 features against a NumPy model of the
per-trajectory semantics (SURVEY section 2), including 1- and 2-point
trajectories, repeated times, backwards time and steps of exactly -1."""

import numpy as np
import pytest

from trailfeat.functions.mathx import MAX_DOUBLE
from trailfeat.operators.features import FEATURES, GUARDED_FROM, feature_matrix
from trailfeat.operators.parse import good, parse_trajectories


def _diff(a, eps=False):
    d = np.diff(a) if len(a) >= 2 else a[:1] - a[:1]
    if eps:
        d = np.where(d == 0, 1e-4, d)
    return d


def _summary(a):
    return {"first": a[0], "last": a[-1], "std": np.std(a), "mean": np.mean(a),
            "median": np.median(a), "max": np.max(a), "min": np.min(a)}


def model(xs, ys, ts, ax, ay):
    n = len(xs)
    dt = _diff(ts, eps=True)
    if n >= 2:
        dx, dy = np.diff(xs), np.diff(ys)
        speed = np.log1p(np.abs(dx)) - np.log1p(dt)
        accel = np.log1p(speed) - np.log1p(dt)
        angle = np.log1p(dy) - np.log1p(dx)
        back = int((dx < 0).sum())
    else:
        speed = accel = angle = np.zeros(1)
        back = 0
    aim = np.array([np.sqrt((xs[-1] - ax) ** 2 + (xs[-1] - ay) ** 2),
                    np.sqrt((ys[-1] - ax) ** 2 + (ys[-1] - ay) ** 2)])
    series = {"x": xs, "y": ys, "t": ts, "time_delta": dt, "log_speed": speed,
              "log_accel": accel, "log_angle": angle, "aim_distance": aim,
              "log_speed_diff": _diff(speed), "log_accel_diff": _diff(accel),
              "log_angle_diff": _diff(angle), "aim_distance_diff": _diff(aim)}
    f = {"point_count": n, "backtrack_count": back,
         "final_dx": xs[-1] - ax, "final_dy": ys[-1] - ay,
         "final_dis": np.sqrt((xs[-1] - ax) ** 2 + (ys[-1] - ay) ** 2),
         "aim_angle": np.log1p(ys[0] - ay) - np.log1p(xs[0] - ax)}
    for name, a in series.items():
        for k, v in _summary(a).items():
            f[f"{name}_{k}"] = v
    f["log_speed_mean_dup"] = f["log_speed_mean"]
    out = [f[c] for c in FEATURES]
    return [float(np.nan_to_num(v)) if i >= GUARDED_FROM else float(v) for i, v in enumerate(out)]


def _random_trajectories(k=300, seed=11):
    rng = np.random.default_rng(seed)
    trajs = []
    for i in range(k):
        n = int(rng.choice([1, 2, 3, 4, 7, 15]))
        steps = rng.choice([-1.0, -2.5, 0.0, 0.5, 1.0, 3.0], size=(n, 2))
        xs, ys = np.cumsum(steps[:, 0]) + rng.integers(-5, 5), np.cumsum(steps[:, 1])
        ts = np.cumsum(rng.choice([0.0, 1.0, 2.0, -1.0, -3.0], size=n))
        ax, ay = float(rng.integers(-5, 5)), float(rng.integers(-5, 5))
        trajs.append((f"r{i}", xs, ys, ts, ax, ay))
    return trajs


def test_features_match_numpy_model(spark):
    trajs = _random_trajectories()
    lines = [f"{tid} " + ";".join(f"{float(x)!r},{float(y)!r},{float(t)!r}" for x, y, t in zip(xs, ys, ts))
             + f"; {ax!r},{ay!r} 1" for tid, xs, ys, ts, ax, ay in trajs]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = {r.traj_id: r for r in feature_matrix(good(parse_trajectories(df))).collect()}
    assert len(got) == len(trajs)
    with np.errstate(all="ignore"):
        for tid, xs, ys, ts, ax, ay in trajs:
            exp = model(xs, ys, ts, ax, ay)
            row = got[tid]
            for c, e in zip(FEATURES, exp):
                g = float(row[c])
                ok = (np.isnan(e) and np.isnan(g)) or g == e or np.isclose(g, e, rtol=1e-9, atol=1e-12)
                assert ok, (tid, c, g, e, list(xs), list(ys), list(ts))
    assert MAX_DOUBLE == np.finfo(float).max
