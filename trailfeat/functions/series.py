"""Per-trajectory series in array form (one row = one trajectory).

Every function maps ``array<double>`` columns to an ``array<double>`` column
with native higher-order functions, so a whole trajectory table is one narrow
stage with no shuffle and no Python.

Short inputs follow the reference's list rules: a first difference of a
1-element series is ``[v - v]`` (the reference repeats the element ten times,
which changes no statistic), and a series that is empty when differenced is
first replaced by ``[0]`` (see ``pad_empty``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .mathx import ZERO_GAP, _c, let, nan_to_num, np_log1p

def EMPTY() -> Column:
    return F.array().cast("array<double>")


def coords(points, field: str) -> Column:
    """``transform(points, p -> p.field)``."""
    return F.transform(_c(points), lambda p: p[field])


def _pairwise(a: Column, fn) -> Column:
    n = F.size(a)
    return F.zip_with(F.slice(a, 2, n - 1), F.slice(a, 1, n - 1), fn)


def first_diff(a, zero_eps: bool = False) -> Column:
    """n >= 2: forward differences; n == 1: ``[v - v]``; n == 0: ``[0]``.

    With ``zero_eps`` a difference equal to 0 becomes 0.0001 (time deltas).
    """
    def body(v):
        n = F.size(v)
        d = (F.when(n >= 2, _pairwise(v, lambda q, p: q - p))
             .when(n == 1, F.array(v[0] - v[0]))
             .otherwise(F.array(F.lit(0.0))))
        if zero_eps:
            d = F.transform(d, lambda e: F.when(e == 0, F.lit(ZERO_GAP)).otherwise(e))
        return d
    return let(body, _c(a))


def raw_diff(a) -> Column:
    """Forward differences only (empty for n < 2); used inside the series maths."""
    return let(lambda v: F.when(F.size(v) >= 2, _pairwise(v, lambda q, p: q - p))
               .otherwise(EMPTY()), _c(a))


def pad_empty(a) -> Column:
    """An empty series becomes ``[0]`` (the reference appends 0 in place)."""
    return let(lambda v: F.when(F.size(v) == 0, F.array(F.lit(0.0))).otherwise(v), _c(a))


def step_distance_x(xs) -> Column:
    """|x[i+1] - x[i]| (the y coordinate is not used)."""
    return F.transform(raw_diff(xs), lambda d: F.abs(d))


def time_delta(ts) -> Column:
    """First difference of t with the zero-gap guard."""
    return first_diff(ts, zero_eps=True)


def _zip_trunc(a: Column, b: Column, fn) -> Column:
    """Python ``zip`` semantics: truncate to the shorter input."""
    def body(p, q):
        m = F.least(F.size(p), F.size(q))
        return F.when(m > 0, F.zip_with(F.slice(p, 1, m), F.slice(q, 1, m), fn)).otherwise(EMPTY())
    return let(body, a, b)


def log_speed_raw(xs, ts) -> Column:
    """log1p(|dx|) - log1p(dt) per step (empty for one point)."""
    return _zip_trunc(step_distance_x(xs), time_delta(_c(ts)),
                      lambda d, t: np_log1p(d) - np_log1p(t))


def log_accel_raw(speed_raw, ts) -> Column:
    """log1p(speed[i]) - log1p(dt[i]) per step (same index, empty for one point)."""
    return _zip_trunc(_c(speed_raw), time_delta(_c(ts)),
                      lambda s, t: np_log1p(s) - np_log1p(t))


def log_angle_raw(xs, ys) -> Column:
    """log1p(dy) - log1p(dx) with signed steps (NaN / -Inf for steps <= -1)."""
    return _zip_trunc(raw_diff(ys), raw_diff(xs),
                      lambda dy, dx: np_log1p(dy) - np_log1p(dx))


def log_speed(xs, ts) -> Column:
    return pad_empty(log_speed_raw(xs, ts))


def log_accel(xs, ts) -> Column:
    return pad_empty(log_accel_raw(log_speed_raw(xs, ts), ts))


def log_angle(xs, ys) -> Column:
    return pad_empty(log_angle_raw(xs, ys))


def aim_distance_compat(xs, ys, aim) -> Column:
    """The two-value series the reference computes from the last point only:
    ``[|(xL, xL) - (ax, ay)|, |(yL, yL) - (ax, ay)|]``."""
    def body(xl, yl, ax, ay):
        return F.array(F.sqrt((xl - ax) * (xl - ax) + (xl - ay) * (xl - ay)),
                       F.sqrt((yl - ax) * (yl - ax) + (yl - ay) * (yl - ay)))
    return let(body, F.element_at(_c(xs), -1), F.element_at(_c(ys), -1),
               _c(aim)["ax"], _c(aim)["ay"])


def aim_distance(points, aim) -> Column:
    """Distance of every point to the target (the corrected reading)."""
    ax, ay = _c(aim)["ax"], _c(aim)["ay"]
    return F.transform(_c(points), lambda p: F.sqrt((p["x"] - ax) * (p["x"] - ax)
                                                    + (p["y"] - ay) * (p["y"] - ay)))


def head_mid_tail(a) -> Column:
    """Head, middle and tail triples after ``nan_to_num``.

    An empty series counts as ``[0]``; a series of at most 3 values is
    repeated 6 times first. mid = len // 2; slices [0:3], [mid-2:mid+1],
    [len-3:len]. Returns ``struct<head, mid, tail>`` of ``array<double>``.
    """
    rep = let(lambda v: F.when(F.size(v) <= 3, F.flatten(F.array_repeat(v, 6))).otherwise(v),
              pad_empty(a))

    def body(v):
        n = F.size(v)
        mid = F.floor(n / 2).cast("int")
        return F.struct(F.slice(v, 1, 3).alias("head"),
                        F.slice(v, mid - 1, 3).alias("mid"),
                        F.slice(v, n - 2, 3).alias("tail"))
    return let(body, F.transform(rep, lambda v: nan_to_num(v)))


def linear_speed_accel(xs, ts) -> Column:
    """The disabled linear forms: ``dx / dt`` and ``diff(dx) / diff_eps(dt)``.

    Returns ``struct<speed, accel>`` of ``array<double>``; dt carries the
    zero-gap guard so no division by zero occurs.
    """
    dx, dt = first_diff(xs), first_diff(ts, zero_eps=True)
    speed = _zip_trunc(dx, dt, lambda a, b: a / b)
    ddx, ddt = first_diff(dx), first_diff(dt, zero_eps=True)
    accel = _zip_trunc(ddx, ddt, lambda a, b: a / b)
    return F.struct(speed.alias("speed"), accel.alias("accel"))
