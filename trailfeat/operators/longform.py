"""Long form: one row per point, for sources that already hold points as rows.

Input is a *lagged* point table (``traj_id, pos, x, y, t`` plus
``x_lag1, x_lag2, ...``, and ``n``, the trajectory's points, where stated) as
produced by :func:`lag_points` or :func:`trailfeat.sources.events.lagged_points`.
From there:

* per-step series are row expressions on the current and previous rows;
* first/last/mean/std/max/min/count are ordinary grouped aggregates, which
  Spark pre-aggregates map-side, so a trajectory holding a third of all rows
  costs one partial row per task, not one task;
* exact medians are part of the same aggregate, except for trajectories with
  more than ``MEDIAN_POINTS`` points: their values are counted in ranges that are
  narrowed round by round (``operators.median``).

A trajectory is never cut, whatever its length. The results equal the array form
row for row (tests/test_longform.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import series as S
from ..functions import stats as A
from ..functions.mathx import MAX_DOUBLE, ZERO_GAP, nan_to_num, np_log1p, zero_gap
from ..plans.sequence import ROWS_PER_BLOCK, sequence
from .features import FEATURES, GUARDED_FROM, _per_context
from .median import counting_medians

STEP_SERIES = ["time_delta", "log_speed", "log_accel", "log_angle"]
DIFF_SERIES = ["log_speed_diff", "log_accel_diff", "log_angle_diff"]


def _log1p(e: str) -> str:
    """``np_log1p`` as SQL text, for short expressions."""
    return f"CASE WHEN {e} < -1 THEN double('NaN') WHEN {e} = -1 THEN double('-Infinity') ELSE log1p({e}) END"


def _gap(e: str) -> str:
    """``zero_gap`` as SQL text."""
    return f"CASE WHEN {e} = 0 THEN {ZERO_GAP!r}D ELSE {e} END"


def _finite(e: str) -> str:
    """``nan_to_num`` as SQL text."""
    return (f"CASE WHEN isnan({e}) THEN 0.0D WHEN {e} = double('Infinity') THEN {MAX_DOUBLE!r}D "
            f"WHEN {e} = double('-Infinity') THEN -{MAX_DOUBLE!r}D ELSE {e} END")


def step_series(lp: DataFrame) -> DataFrame:
    """Add ``dx, dy, step_distance_x, time_delta, log_speed, log_accel, log_angle`` (NULL at
    pos 0) and the second differences ``log_*_diff`` (NULL at pos < 2)."""
    df = lp.selectExpr("*", "x - x_lag1 AS dx", "y - y_lag1 AS dy", "abs(x - x_lag1) AS step_distance_x",
                       f"{_gap('(t - t_lag1)')} AS time_delta")
    two = "x_lag2" in lp.columns
    if two:
        df = df.selectExpr("*", "abs(x_lag1 - x_lag2) AS _pd", "x_lag1 - x_lag2 AS _pdx", "y_lag1 - y_lag2 AS _pdy",
                           f"{_gap('(t_lag1 - t_lag2)')} AS _pdt")
    df = df.selectExpr("*", f"{_log1p('step_distance_x')} - ({_log1p('time_delta')}) AS log_speed",
                       f"{_log1p('dy')} - ({_log1p('dx')}) AS log_angle",
                       *([f"{_log1p('_pd')} - ({_log1p('_pdt')}) AS _psp", f"{_log1p('_pdy')} - ({_log1p('_pdx')}) AS _pan"]
                         if two else []))
    df = df.selectExpr("*", f"{_log1p('log_speed')} - ({_log1p('time_delta')}) AS log_accel")
    if two:
        df = df.selectExpr("*", "log_speed - _psp AS log_speed_diff",
                           f"log_accel - ({_log1p('_psp')} - ({_log1p('_pdt')})) AS log_accel_diff",
                           "log_angle - _pan AS log_angle_diff").drop("_pd", "_pdx", "_pdy", "_pdt", "_psp", "_pan")
    return df


def _stats_aggs(v: str) -> list[str]:
    at = f"CASE WHEN {v} IS NOT NULL THEN pos END"
    return [f"count({v}) AS {v}__n", f"min_by({v}, {at}) AS {v}__first", f"max_by({v}, {at}) AS {v}__last",
            f"avg({v}) AS {v}__mean", f"stddev_pop({v}) AS {v}__std", f"max({v}) AS {v}__max", f"min({v}) AS {v}__min",
            f"max(CAST(isnan({v}) AS INT)) AS {v}__nan"]


#: Points up to which the medians of a trajectory are part of the grouped aggregate (a map of values for
#: each series); longer ones are counted in ranges (see ``operators.median``).
MEDIAN_POINTS = 200_000


def heavy_keys(points: DataFrame, key: str = "traj_id", rows_per_block: int = MEDIAN_POINTS) -> DataFrame | None:
    """Trajectories with more than ``rows_per_block`` points (at most one for so many rows), or None without any.

    Runs one small aggregate, so that plans hold the branch for such trajectories
    only where there are some.
    """
    found = points.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_block).select(key)
    return None if found.isEmpty() else found


def _light_median(v: str) -> str:
    """Exact median of the non-NaN values of trajectories that are not heavy."""
    return f"percentile(CASE WHEN _heavy IS NULL AND NOT isnan({v}) THEN CAST({v} AS DOUBLE) END, 0.5D) AS {v}__median"


def heavy_medians(steps: DataFrame, names, key: str = "traj_id") -> DataFrame:
    """``(key, <series>__heavy ...)``: exact medians of the non-NaN values of long trajectories, by counting selection."""
    names = list(names)
    stacked = steps.selectExpr(key, "inline(array(" + ", ".join(
        f"named_struct('sid', {i}, 'v', CAST({v} AS DOUBLE))" for i, v in enumerate(names)) + "))")
    found = counting_medians(stacked, [key, "sid"])
    return found.groupBy(key).agg(*[F.expr(f"max(CASE WHEN sid = {i} THEN median END) AS {v}__heavy") for i, v in enumerate(names)])


def trajectory_summaries(steps: DataFrame, key: str = "traj_id", medians=None, heavy: DataFrame | None = None,
                         heavy_steps: DataFrame | None = None) -> DataFrame:
    """One row per trajectory: count, backtracks and the raw (unguarded)
    first/last/std/mean/median/max/min of every series, with the reference's
    short-trajectory rules applied. Columns are ``<series>_<stat>``.

    The constants ``ax, ay, label`` (where present) are those of the first point;
    ``reason`` says why a trajectory is bad (``no_id``, ``bad_point``,
    ``bad_target``, or ``varying_constants`` when they differ between points) and
    is null for good ones. ``medians`` limits the medians to some series (the
    others' ``_median`` is NULL). ``heavy`` are the trajectories too long for one task
    (see :func:`heavy_keys`; None: there are none), and ``heavy_steps`` their steps
    where the caller can make them from fewer points.
    """
    have_diff = "log_speed_diff" in steps.columns
    series = ["x", "y", "t"] + STEP_SERIES + (DIFF_SERIES if have_diff else [])
    ranked = [v for v in series if medians is None or v in medians]
    consts = [c for c in ("ax", "ay", "label") if c in steps.columns]
    if heavy is None:
        marked = steps.withColumn("_heavy", F.lit(None).cast("boolean"))
    else:
        marked = steps.join(heavy.withColumn("_heavy", F.lit(True)), key, "left")
    df = marked.groupBy(key).agg(*_per_context(
        steps, ("aggs", tuple(series), tuple(ranked), tuple(consts)), lambda: _base_aggs(series, ranked, consts)))
    if heavy is None:
        df = df.select("*", *[F.lit(None).cast("double").alias(f"{v}__heavy") for v in ranked])
    else:
        only = steps.join(heavy, key, "left_semi") if heavy_steps is None else heavy_steps
        df = df.join(heavy_medians(only, ranked, key), key, "left")
    out = [F.col(key), *[F.col(e) for e in consts]]
    out += _per_context(steps, ("outs", tuple(series), tuple(ranked), tuple(consts), key),
                        lambda: _summary_outputs(series, ranked, consts, key))
    return df.select(*out)


def _constant(c: str) -> str:
    """A number that tells values of a constant apart (null is a value too)."""
    return f"xxhash64({c})" if c == "label" else f"coalesce(CAST({c} AS DOUBLE), double('NaN'))"


def _base_aggs(series, ranked, consts) -> list[Column]:
    aggs = ["count(1) AS point_count", "count(x + y + t) AS _whole",
            "CAST(sum(CASE WHEN dx < 0 THEN 1 ELSE 0 END) AS BIGINT) AS backtrack_count"]
    for c in consts:
        aggs += [f"max(CASE WHEN pos = 0 THEN {c} END) AS {c}",
                 f"min({_constant(c)}) AS _min_{c}", f"max({_constant(c)}) AS _max_{c}"]
    for v in series:
        aggs += _stats_aggs(v)
    return [F.expr(e) for e in aggs + [_light_median(v) for v in ranked]]


def _summary_outputs(series, ranked, consts, key) -> list[Column]:
    """Guards and short-trajectory fallbacks over the grouped aggregates."""
    reason = f"CASE WHEN {key} IS NULL THEN 'no_id' WHEN _whole < point_count THEN 'bad_point'"
    if "ax" in consts:
        reason += " WHEN ax IS NULL OR ay IS NULL THEN 'bad_target'"
    for e in consts:
        reason += f" WHEN _min_{e} != _max_{e} THEN 'varying_constants'"
    out = ["point_count", "backtrack_count", f"{reason} END AS reason"]
    fallback = {"time_delta": _gap("(t__first - t__first)"), "log_speed": "0.0D", "log_accel": "0.0D", "log_angle": "0.0D"}
    for s in ("log_speed", "log_accel", "log_angle"):
        fallback[f"{s}_diff"] = f"(CASE WHEN point_count = 1 THEN 0.0D ELSE {s}__first - {s}__first END)"
    for v in series:
        def or_nan(e: str, v: str = v) -> str:
            return f"CASE WHEN {v}__nan = 1 THEN double('NaN') ELSE {e} END"
        stats = {"first": f"{v}__first", "last": f"{v}__last",
                 **{k: or_nan(f"{v}__{k}") for k in ("std", "mean", "max", "min")},
                 "median": or_nan(f"coalesce({v}__heavy, {v}__median)") if v in ranked else "CAST(NULL AS DOUBLE)"}
        if v in fallback:
            one = fallback[v]
            stats = {k: f"CASE WHEN {v}__n = 0 THEN {f'abs({one} - {one})' if k == 'std' else one} ELSE {e} END"
                     for k, e in stats.items()}
        out += [f"{stats[k]} AS {v}_{k}" for k in A.STATS]
    return [F.expr(e) for e in out]


def aim_pair() -> tuple[Column, Column]:
    """The two-value target distance, from the last point (columns ``x_last, y_last, ax, ay``)."""
    xl, yl, ax, ay = F.col("x_last"), F.col("y_last"), F.col("ax"), F.col("ay")
    return (F.sqrt((xl - ax) * (xl - ax) + (xl - ay) * (xl - ay)), F.sqrt((yl - ax) * (yl - ax) + (yl - ay) * (yl - ay)))


def feature_matrix_long(steps: DataFrame, labelled: bool = True, key: str = "traj_id", heavy: DataFrame | None = None,
                        heavy_steps: DataFrame | None = None,
                        with_speed_median: bool = False, with_reason: bool = False) -> DataFrame:
    """The 70 features from a lagged point table (same columns as the array form).

    ``with_reason`` adds ``reason`` (null for good trajectories); without it bad
    ones (see :func:`trajectory_summaries`) are refused with an error.
    """
    used = {f[:-len("_median")] for f in FEATURES if f.endswith("_median")}
    used |= {"log_speed"} if with_speed_median else set()
    s = trajectory_summaries(steps, key, medians=used, heavy=heavy, heavy_steps=heavy_steps)
    d1, d2 = aim_pair()
    s = s.select("*", d1.alias("_d1"), d2.alias("_d2"))
    nan = "isnan(_d1) OR isnan(_d2)"
    named = {f"aim_distance_{k}": e for k, e in {
        "first": "_d1", "last": "_d2", "mean": "(_d1 + _d2) / 2", "median": "(_d1 + _d2) / 2", "max": "greatest(_d1, _d2)",
        "min": f"CASE WHEN {nan} THEN double('NaN') ELSE least(_d1, _d2) END"}.items()}
    # a series of one value
    named |= {f"aim_distance_diff_{k}": "_d2 - _d1" for k in ("first", "last", "mean", "median", "max", "min")}
    bad = f"CAST(raise_error(concat('bad trajectory ', coalesce(CAST({key} AS STRING), '?'), ': ', reason)) AS BIGINT)"
    named["point_count"] = "point_count" if with_reason else f"CASE WHEN reason IS NOT NULL THEN {bad} ELSE point_count END"
    named["final_dis"] = "sqrt((x_last - ax) * (x_last - ax) + (y_last - ay) * (y_last - ay))"
    named["final_dx"], named["final_dy"] = "x_last - ax", "y_last - ay"
    named["log_speed_mean_dup"] = "log_speed_mean"
    named["aim_angle"] = f"{_log1p('(y_first - ay)')} - ({_log1p('(x_first - ax)')})"
    s = s.selectExpr(key, *[f"{named.get(f, f)} AS {f}" for f in FEATURES], *(["log_speed_median"] if with_speed_median else []),
                     *(["label"] if labelled else []), *(["reason"] if with_reason else []))
    guarded = [*FEATURES[GUARDED_FROM:], "log_speed_median"]
    return s.selectExpr(*[f"{_finite(c)} AS {c}" if c in guarded else c for c in s.columns])


def _rows(steps: DataFrame, index: Column, value: Column, key: str, *extra) -> DataFrame:
    return steps.select(key, *extra, index.cast("long").alias("i"), value.alias("v")).where("i is not null")


def series_rows(steps: DataFrame, name: str, key: str = "traj_id", *extra) -> DataFrame:
    """``(key, i, v)`` of one step or difference series on whole trajectories (needs ``n``).

    Rules for short ones: one point gives one value (the difference of a point to
    itself, or 0; none for ``step_distance_x``), two points one second difference.
    """
    pos, n, v = F.col("pos"), F.col("n"), F.col(name)
    if name in DIFF_SERIES:
        of = F.col(name[:-len("_diff")])
        index = F.when(pos >= 2, pos - 2).when((n == 2) & (pos == 1), 0).when(n == 1, 0)
        value = F.when(pos >= 2, v).when(n == 2, of - of).otherwise(F.lit(0.0))
    else:
        own = {"dx": F.col("x") - F.col("x"), "dy": F.col("y") - F.col("y"),
               "time_delta": zero_gap(F.col("t") - F.col("t"))}.get(name, F.lit(0.0))
        index = F.when(pos >= 1, pos - 1)
        index = index if name == "step_distance_x" else index.when(n == 1, 0)
        value = F.when(pos >= 1, v).otherwise(own)
    return _rows(steps, index, value, key, *extra)


SLICED_SERIES = ["log_speed", "log_accel", "log_angle", *DIFF_SERIES]


def head_mid_tail_rows(steps: DataFrame, names=SLICED_SERIES, key: str = "traj_id") -> DataFrame:
    """``(key, series, part, i, v)``: three values each from the head, middle and tail of every series (needs ``n``).

    A row knows from its index which slices it is in, so only those rows go on;
    series of at most three values are gathered (bounded) and take the array rule.
    """
    def entry(name: str) -> str:
        of = name[:-len("_diff")]
        off, own = (2, f"CASE WHEN n = 2 THEN {of} - {of} ELSE 0.0D END") if name in DIFF_SERIES else (1, "0.0D")
        return f"named_struct('series', '{name}', 'off', {off}, 'v', CASE WHEN pos >= {off} THEN {name} ELSE {own} END)"

    # all series in one pass; short ones as in series_rows
    stacked = steps.selectExpr(key, "n", "pos", f"inline(array({', '.join(map(entry, names))}))").selectExpr(
        key, "series", "greatest(n - off, 1) AS m", "v",
        "CASE WHEN pos >= off THEN pos - off WHEN n = 1 THEN 0 WHEN off = 2 AND n = 2 AND pos = 1 THEN 0 END AS i")
    out = stacked.where("i < 3 OR i >= m - 3 OR (i >= floor(m / 2) - 2 AND i < floor(m / 2) + 1)")
    mid = F.floor(F.col("m") / 2)
    slots = [F.when(F.col("i") < 3, F.struct(F.lit("head").alias("part"), F.col("i").alias("at"))),
             F.when((F.col("i") >= mid - 2) & (F.col("i") < mid + 1), F.struct(F.lit("mid").alias("part"), (F.col("i") - mid + 2).alias("at"))),
             F.when(F.col("i") >= F.col("m") - 3, F.struct(F.lit("tail").alias("part"), (F.col("i") - F.col("m") + 3).alias("at")))]
    long = out.where("m > 3").select(key, "series", "v", F.explode(F.array_compact(F.array(*slots))).alias("s")).select(
        key, "series", "s.part", F.col("s.at").cast("long").alias("i"), nan_to_num("v").alias("v"))
    arrays = out.where("m <= 3").groupBy(key, "series").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("a"))
    cut = arrays.select(key, "series", S.head_mid_tail(F.col("a.v")).alias("h"))
    short = cut.select(key, "series", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.col(f"h.{p}").alias("vals"))
                                                          for p in ("head", "mid", "tail")])).alias("p"))
    short = short.select(key, "series", "p.part", F.posexplode("p.vals").alias("i", "v")).select(
        key, "series", "part", F.col("i").cast("long").alias("i"), "v")
    return long.unionByName(short)


def linear_rows(steps: DataFrame, key: str = "traj_id") -> DataFrame:
    """``(key, kind, i, v)``: dx / dt, and diff(dx) / diff(dt) with the zero-gap guard (needs ``n`` and two lags)."""
    pos, n = F.col("pos"), F.col("n")
    dx, dt = F.col("dx"), F.col("time_delta")
    dx1, dt1 = F.col("x_lag1") - F.col("x_lag2"), zero_gap(F.col("t_lag1") - F.col("t_lag2"))
    x0, t0 = F.col("x") - F.col("x"), zero_gap(F.col("t") - F.col("t"))
    speed = _rows(steps, F.when(pos >= 1, pos - 1).when(n == 1, 0), F.when(pos >= 1, dx / dt).otherwise(x0 / t0), key,
                  F.lit("speed").alias("kind"))
    accel = _rows(steps, F.when(pos >= 2, pos - 2).when((n == 2) & (pos == 1), 0).when(n == 1, 0),
                  F.when(pos >= 2, (dx - dx1) / zero_gap(dt - dt1)).when(n == 2, (dx - dx) / zero_gap(dt - dt))
                  .otherwise((x0 - x0) / zero_gap(t0 - t0)), key, F.lit("accel").alias("kind"))
    return speed.unionByName(accel)


def aim_distance_rows(points: DataFrame, key: str = "traj_id") -> DataFrame:
    """``(key, i, v)``: the distance of every point to the target."""
    dx, dy = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    return points.select(key, F.col("pos").alias("i"), F.sqrt(dx * dx + dy * dy).alias("v"))


def continuity(steps: DataFrame, key: str = "traj_id") -> DataFrame:
    """sum(|d|) / n of x, y and t (divides by n, not n - 1); 0 for one point."""
    return steps.groupBy(key).agg(*[F.coalesce(
        F.sum(F.abs(F.col(c) - F.col(f"{c}_lag1"))) / F.count(F.lit(1)), F.lit(0.0)).alias(f"c{c}") for c in "xyt"])


def ends(points: DataFrame, key: str = "traj_id", extra=()) -> DataFrame:
    """Count, first and last x, y, t of every trajectory, and its numeric constants, by partial aggregates."""
    aggs = []
    for v in ("x", "y", "t"):
        aggs += [F.min_by(v, "pos").alias(f"{v}_first"), F.max_by(v, "pos").alias(f"{v}_last")]
    return points.groupBy(key).agg(F.count(F.lit(1)).alias("point_count"), *aggs, *[F.max(c).alias(c) for c in extra])


def final_offset(points: DataFrame, key: str = "traj_id") -> DataFrame:
    """``dis, dx, dy`` from the last point to the target."""
    dx, dy = F.col("x_last") - F.col("ax"), F.col("y_last") - F.col("ay")
    return ends(points, key, ("ax", "ay")).select(key, F.sqrt(dx * dx + dy * dy).alias("dis"), dx.alias("dx"), dy.alias("dy"))


def net_displacement(points: DataFrame, key: str = "traj_id") -> DataFrame:
    """Last minus first of x and y, and the absolute difference of t."""
    return ends(points, key).select(key, (F.col("x_last") - F.col("x_first")).alias("dx"),
                                    (F.col("y_last") - F.col("y_first")).alias("dy"),
                                    F.abs(F.col("t_last") - F.col("t_first")).alias("dt"))


def aim_angle(points: DataFrame, key: str = "traj_id") -> DataFrame:
    """log1p(y0 - ay) - log1p(x0 - ax) from the first point."""
    return ends(points, key, ("ax", "ay")).select(key, (
        np_log1p(F.col("y_first") - F.col("ay")) - np_log1p(F.col("x_first") - F.col("ax"))).alias("aim_angle"))


def aim_distance_pairs(points: DataFrame, key: str = "traj_id") -> DataFrame:
    """``(key, aim0, aim1)``: the two-value target distance of every trajectory."""
    d1, d2 = aim_pair()
    return ends(points, key, ("ax", "ay")).select(key, d1.alias("aim0"), d2.alias("aim1"))


def lag_points(points: DataFrame, key: str = "traj_id", order=("pos",), lags: int = 2,
               rows_per_block: int | None = None) -> DataFrame:
    """Generic point table -> lagged point table (with ``n``) via the skew-safe scan.

    Points are ordered by ``order`` within ``key``; equal orders are refused.
    When the table has no ``pos`` column, the 0-based position from the scan
    becomes ``pos``.
    """
    pos = "_seqpos" if "pos" in points.columns else "pos"
    out = sequence(points, [key], list(order), lag_cols=["x", "y", "t"], lags=lags, with_count=True,
                   rows_per_block=rows_per_block, pos_col=pos).withColumnRenamed("seq_n", "n")
    return out.drop("pos").withColumnRenamed("_seqpos", "pos") if pos == "_seqpos" else out
