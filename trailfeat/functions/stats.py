"""Per-trajectory summaries in array form.

``summary`` reproduces NumPy's first/last/std/mean/median/max/min on a
non-empty ``array<double>``: population std, and any NaN makes
std/mean/median/max/min NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .mathx import NAN, _c, euclid2, let, np_log1p
from .series import raw_diff

STATS = ("first", "last", "std", "mean", "median", "max", "min")


def array_sum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda s, v: s + v)


def array_mean(a) -> Column:
    a = _c(a)
    return array_sum(a) / F.size(a)


def array_std(a, mean: Column | None = None) -> Column:
    """Two-pass population standard deviation."""
    a = _c(a)
    m = array_mean(a) if mean is None else mean
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + (v - m) * (v - m)) / F.size(a))


def _sorted_stats(srt: Column) -> tuple[Column, Column, Column]:
    """median, max, min from an ascending ``array_sort`` result.

    Spark sorts NaN after every number, so the series holds a NaN exactly when
    its last sorted element is NaN; then median and min are NaN (as in NumPy)
    and the max is that NaN already.
    """
    n = F.size(srt)
    bad = F.isnan(F.element_at(srt, -1))
    lo = F.get(srt, F.floor((n - 1) / 2).cast("int"))
    hi = F.get(srt, F.floor(n / 2).cast("int"))
    return (F.when(bad, NAN()).otherwise((lo + hi) / 2), F.element_at(srt, -1),
            F.when(bad, NAN()).otherwise(srt[0]))


def array_median(a) -> Column:
    return let(lambda srt: _sorted_stats(srt)[0], F.array_sort(_c(a)))


def summary(a) -> Column:
    """``struct<first,last,std,mean,median,max,min>`` of a non-empty series.

    One sort plus two passes (sum, squared deviations) per series.
    """
    def body(v, mean, srt):
        med, mx, mn = _sorted_stats(srt)
        return F.struct(
            v[0].alias("first"),
            F.element_at(v, -1).alias("last"),
            array_std(v, mean).alias("std"),
            mean.alias("mean"),
            med.alias("median"),
            mx.alias("max"),
            mn.alias("min"),
        )
    return let(lambda v: let(lambda m, srt: body(v, m, srt), array_mean(v), F.array_sort(v)),
               _c(a))


def point_count(xs) -> Column:
    return F.size(_c(xs)).cast("long")


def backtrack_count(xs) -> Column:
    """Number of strictly negative x steps (0 for fewer than two points)."""
    return F.size(F.filter(raw_diff(xs), lambda d: d < 0)).cast("long")


def continuity(xs) -> Column:
    """sum(|dx|) / n (divides by n, not n - 1); 0 for one point."""
    xs = _c(xs)
    d = raw_diff(xs)
    return F.when(F.size(xs) > 1,
                  F.aggregate(d, F.lit(0.0), lambda s, v: s + F.abs(v)) / F.size(xs)
                  ).otherwise(F.lit(0.0))


def final_offset(xs, ys, aim) -> Column:
    """``struct<dis, dx, dy>`` from the last point to the target."""
    dx = F.element_at(_c(xs), -1) - _c(aim)["ax"]
    dy = F.element_at(_c(ys), -1) - _c(aim)["ay"]
    return F.struct(euclid2(dx, dy).alias("dis"), dx.alias("dx"), dy.alias("dy"))


def net_displacement(xs, ys, ts) -> Column:
    """``struct<dx, dy, dt>``: last minus first, |t_last - t_first|."""
    xs, ys, ts = _c(xs), _c(ys), _c(ts)
    return F.struct((F.element_at(xs, -1) - xs[0]).alias("dx"),
                    (F.element_at(ys, -1) - ys[0]).alias("dy"),
                    F.abs(F.element_at(ts, -1) - ts[0]).alias("dt"))


def aim_angle(xs, ys, aim) -> Column:
    """log1p(y0 - ay) - log1p(x0 - ax) from the first point."""
    return (np_log1p(_c(ys)[0] - _c(aim)["ay"]) - np_log1p(_c(xs)[0] - _c(aim)["ax"]))
