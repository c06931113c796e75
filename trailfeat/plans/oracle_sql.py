"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain ``PARTITION BY`` windows, ``lag`` and grouped aggregates over the driver's
``events`` view, with the short-trajectory rules spelled out as extra ``UNION
ALL`` rows. Fixed values (feature order, guard, constants, the rounding grid) are
written out here again and not taken from the engine's modules.
"""

from __future__ import annotations

STATS = ("first", "last", "std", "mean", "median", "max", "min")
# The feature order of the reference's output rows (70 columns).
FEATURE_ORDER = """
point_count backtrack_count
x_first x_mean x_median x_std x_max x_min x_last
y_first y_mean y_median y_std y_max y_min y_last
t_first t_mean t_median t_std t_max t_min t_last
time_delta_first time_delta_mean time_delta_median time_delta_std time_delta_max time_delta_min time_delta_last
final_dis final_dx final_dy
log_speed_mean log_speed_mean_dup log_speed_max log_speed_min
log_accel_mean log_accel_median log_accel_max log_accel_min
log_angle_mean log_angle_median log_angle_max log_angle_min
aim_distance_first aim_distance_last aim_distance_mean aim_distance_median aim_distance_max aim_distance_min
log_speed_diff_mean log_speed_diff_median log_speed_diff_max log_speed_diff_min
log_accel_diff_mean log_accel_diff_median log_accel_diff_max log_accel_diff_min
log_angle_diff_mean log_angle_diff_median log_angle_diff_max log_angle_diff_min
aim_distance_diff_first aim_distance_diff_last aim_distance_diff_mean
aim_distance_diff_median aim_distance_diff_max aim_distance_diff_min
aim_angle
""".split()
RAW_FEATURES = 33            # the first 33 columns are emitted as they are, the others after nan_to_num
EXACT = {f"{v}_{k}" for v in ("x", "y", "t", "time_delta") for k in ("first", "last", "max", "min")} | {"final_dx", "final_dy"}


def settle(e: str) -> str:
    """Half away from zero on a grid of 2^-20 below 1e6 and 2^-10 below 2^42; other values as they are."""
    e = f"CAST(({e}) AS DOUBLE)"

    def half(scale: int) -> str:
        a = f"(CAST(floor(abs({e}) * {scale}.0::DOUBLE + 0.5) AS DOUBLE) / {scale}.0::DOUBLE)"
        return f"(CASE WHEN {e} < 0 THEN -{a} ELSE {a} END)"
    r = (f"(CASE WHEN {e} IS NULL OR isnan({e}) OR isinf({e}) OR abs({e}) >= 4398046511104.0 THEN {e} "
         f"WHEN abs({e}) < 1e6 THEN {half(1048576)} ELSE {half(1024)} END)")
    return f"(CASE WHEN {r} = 0 THEN 0.0 ELSE {r} END)"


def L(e: str) -> str:
    """NumPy log1p."""
    return (f"(CASE WHEN ({e}) < -1 THEN 'nan'::DOUBLE WHEN ({e}) = -1 THEN '-inf'::DOUBLE "
            f"ELSE ln(1 + ({e})) END)")


def G(e: str) -> str:
    """Zero-gap guard."""
    return f"(CASE WHEN ({e}) = 0 THEN 0.0001 ELSE ({e}) END)"


def N2N(e: str) -> str:
    return (f"(CASE WHEN isnan({e}) THEN 0.0 WHEN ({e}) = 'inf'::DOUBLE THEN 1.7976931348623157e308 "
            f"WHEN ({e}) = '-inf'::DOUBLE THEN -1.7976931348623157e308 ELSE ({e}) END)")


def D(e: str, alias: str) -> str:
    return f"{settle(e)} AS {alias}"


def X(e: str, alias: str) -> str:
    """An exact double."""
    return f"CAST({e} AS DOUBLE) AS {alias}"


def I(e: str, alias: str) -> str:
    return f"CAST({e} AS BIGINT) AS {alias}"


EV = ("ev AS (SELECT event_id, ts, user_id, value, "
      "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)")

VIEW = {
    "A": ("pv AS (SELECT user_id AS uid, ts, row_number() OVER w - 1 AS upos, "
          "value AS x, CAST(k AS DOUBLE) AS y, "
          "CAST((epoch_us(ts) - epoch_us(first_value(ts) OVER w)) // 1000 AS DOUBLE) AS t "
          "FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"),
    "B": ("pv AS (SELECT user_id AS uid, ts, row_number() OVER w - 1 AS upos, "
          "CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS DOUBLE) / 100 AS x, "
          "CAST(sum(k) OVER w AS DOUBLE) AS y, CAST(sum(event_id % 3) OVER w AS DOUBLE) AS t "
          "FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"),
}

TARGET = ("CAST((uid * 7) % 500 AS DOUBLE) AS ax, CAST((uid * 3) % 100 AS DOUBLE) AS ay, "
          "CAST(uid % 2 AS VARCHAR) AS label")


def points_cte(view: str = "B", weekly: bool = False) -> str:
    """Whole users, or (the text form) a user's points of one calendar week."""
    if weekly:
        tid = "CAST(uid AS VARCHAR) || '-' || strftime(date_trunc('week', ts), '%Y%m%d')"
        pos = "row_number() OVER (PARTITION BY uid, date_trunc('week', ts) ORDER BY upos) - 1"
    else:
        tid, pos = "uid", "upos"
    return (f"{EV}, {VIEW[view]}, "
            f"pts AS (SELECT uid, {tid} AS traj_id, {pos} AS pos, x, y, t, {TARGET} FROM pv)")


SERIES_CTE = f"""
pn AS (SELECT *, count(*) OVER (PARTITION BY traj_id) AS n FROM pts),
s1 AS (SELECT *, lag(x) OVER w AS x1, lag(y) OVER w AS y1, lag(t) OVER w AS t1,
              lag(x, 2) OVER w AS x2, lag(y, 2) OVER w AS y2, lag(t, 2) OVER w AS t2
       FROM pn WINDOW w AS (PARTITION BY traj_id ORDER BY pos)),
s2 AS (SELECT *, x - x1 AS dx, y - y1 AS dy, {G('t - t1')} AS dt,
              x1 - x2 AS pdx, y1 - y2 AS pdy, {G('t1 - t2')} AS pdt FROM s1),
s3 AS (SELECT *, {L('abs(dx)')} - {L('dt')} AS sp, {L('dy')} - {L('dx')} AS an,
              {L('abs(pdx)')} - {L('pdt')} AS psp, {L('pdy')} - {L('pdx')} AS pan FROM s2),
s4 AS (SELECT *, {L('sp')} - {L('dt')} AS ac, {L('psp')} - {L('pdt')} AS pac FROM s3),
s5 AS (SELECT *, sp - psp AS spd, ac - pac AS acd, an - pan AS and2 FROM s4),
tr AS (SELECT traj_id, any_value(uid) AS uid, count(*) AS n,
              arg_min(x, pos) AS x0, arg_min(y, pos) AS y0, arg_min(t, pos) AS t0,
              arg_max(x, pos) AS xl, arg_max(y, pos) AS yl, arg_max(t, pos) AS tl,
              any_value(ax) AS ax, any_value(ay) AS ay, any_value(label) AS label,
              sum(CASE WHEN dx < 0 THEN 1 ELSE 0 END) AS backs
       FROM s5 GROUP BY traj_id),
ad AS (SELECT *, sqrt((xl - ax) * (xl - ax) + (xl - ay) * (xl - ay)) AS d1,
              sqrt((yl - ax) * (yl - ax) + (yl - ay) * (yl - ay)) AS d2 FROM tr),
ser AS (
  SELECT traj_id, 'x' AS sid, pos AS i, x AS v FROM s5
  UNION ALL SELECT traj_id, 'y', pos, y FROM s5
  UNION ALL SELECT traj_id, 't', pos, t FROM s5
  UNION ALL SELECT traj_id, 'dx', pos - 1, dx FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'dx', 0, x - x FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'dy', pos - 1, dy FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'dy', 0, y - y FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'step_distance_x', pos - 1, abs(dx) FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'time_delta', pos - 1, dt FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'time_delta', 0, {G('t - t')} FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_speed', pos - 1, sp FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'log_speed', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_accel', pos - 1, ac FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'log_accel', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_angle', pos - 1, an FROM s5 WHERE pos >= 1
  UNION ALL SELECT traj_id, 'log_angle', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_speed_diff', pos - 2, spd FROM s5 WHERE pos >= 2
  UNION ALL SELECT traj_id, 'log_speed_diff', 0, sp - sp FROM s5 WHERE n = 2 AND pos = 1
  UNION ALL SELECT traj_id, 'log_speed_diff', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_accel_diff', pos - 2, acd FROM s5 WHERE pos >= 2
  UNION ALL SELECT traj_id, 'log_accel_diff', 0, ac - ac FROM s5 WHERE n = 2 AND pos = 1
  UNION ALL SELECT traj_id, 'log_accel_diff', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'log_angle_diff', pos - 2, and2 FROM s5 WHERE pos >= 2
  UNION ALL SELECT traj_id, 'log_angle_diff', 0, an - an FROM s5 WHERE n = 2 AND pos = 1
  UNION ALL SELECT traj_id, 'log_angle_diff', 0, 0.0 FROM s5 WHERE n = 1
  UNION ALL SELECT traj_id, 'aim_distance', 0, d1 FROM ad
  UNION ALL SELECT traj_id, 'aim_distance', 1, d2 FROM ad
  UNION ALL SELECT traj_id, 'aim_distance_diff', 0, d2 - d1 FROM ad
),
sst AS (SELECT traj_id, sid, arg_min(v, i) AS "first", arg_max(v, i) AS "last",
        CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE stddev_pop(v) END AS std,
        CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE avg(v) END AS mean,
        CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE median(v) END AS median,
        CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE max(v) END AS max,
        CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE min(v) END AS min
        FROM ser GROUP BY traj_id, sid)
"""


def base(view: str = "B", weekly: bool = False) -> str:
    return f"WITH {points_cte(view, weekly)}, {SERIES_CTE}"


def series_sql(sid: str, view="B", exact=False) -> str:
    return f"{base(view)} SELECT traj_id, {I('i', 'i')}, {(X if exact else D)('v', 'v')} FROM ser WHERE sid = '{sid}'"


def stats_sql(sid: str, view="B") -> str:
    exact = sid in ("x", "y", "t", "time_delta")
    cols = ", ".join((X if exact and k in ("first", "last", "max", "min") else D)(f'"{k}"', k) for k in STATS)
    return f"{base(view)} SELECT traj_id, {cols} FROM sst WHERE sid = '{sid}'"


def medians_sql(view="B") -> str:
    names = {"x": "x", "y": "y", "t": "t", "time_delta": "dt", "log_speed": "sp", "log_accel": "ac", "log_angle": "an"}
    rows = " UNION ALL ".join(f"SELECT traj_id, '{k}' AS series, CAST({c} AS DOUBLE) AS v FROM s5" for k, c in names.items())
    return (f"{base(view)} SELECT traj_id, series, {I('count(*)', 'n')}, {D('median(v)', 'median')} FROM ({rows}) "
            "WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY traj_id, series")


def incremental_sql(view="B") -> str:
    names = {"x": "x", "y": "y", "t": "t", "time_delta": "dt", "log_speed": "sp", "log_accel": "ac", "log_angle": "an"}
    rows = " UNION ALL ".join(f"SELECT traj_id, '{k}' AS series, pos, CAST({c} AS DOUBLE) AS v FROM s5" for k, c in names.items())
    nan = "CASE WHEN bool_or(isnan(v)) THEN 'nan'::DOUBLE ELSE {} END"
    return (f"{base(view)} SELECT traj_id, series, {I('count(*) FILTER (NOT isnan(v))', 'n')}, {D('arg_min(v, pos)', 'first')}, "
            f"{D('arg_max(v, pos)', 'last')}, {D(nan.format('avg(v)'), 'mean')}, {D(nan.format('stddev_pop(v)'), 'std')}, "
            f"{D(nan.format('max(v)'), 'max')}, {D(nan.format('min(v)'), 'min')} FROM ({rows}) WHERE v IS NOT NULL GROUP BY traj_id, series")


def _feature_exprs() -> list[tuple[str, str]]:
    out = []
    special = {
        "point_count": None, "backtrack_count": None,
        "final_dis": "sqrt((xl - ax) * (xl - ax) + (yl - ay) * (yl - ay))",
        "final_dx": "xl - ax", "final_dy": "yl - ay",
        "aim_angle": f"{L('y0 - ay')} - {L('x0 - ax')}",
        "log_speed_mean_dup": "log_speed_mean",
    }
    for i, f in enumerate(FEATURE_ORDER):
        if f in ("point_count", "backtrack_count"):
            continue
        e = special.get(f, f)
        out.append((N2N(e) if i >= RAW_FEATURES else e, f))
    return out


def _pivot_cols() -> str:
    sids = ["x", "y", "t", "time_delta", "log_speed", "log_accel", "log_angle", "aim_distance",
            "log_speed_diff", "log_accel_diff", "log_angle_diff", "aim_distance_diff"]
    return ", ".join(f'max(CASE WHEN sid = \'{s}\' THEN "{k}" END) AS {s}_{k}'
                     for s in sids for k in STATS)


def _features(view: str, weekly: bool) -> str:
    return (f"{base(view, weekly)}, pv2 AS (SELECT traj_id, {_pivot_cols()} FROM sst "
            f"GROUP BY traj_id), fx AS (SELECT * FROM ad JOIN pv2 USING (traj_id))")


def feature_sql(view="B", weekly=False, labelled=True, speed_median=False) -> str:
    cols = ", ".join((X if a in EXACT else D)(e, a) for e, a in _feature_exprs())
    more = f", {D(N2N('log_speed_median'), 'log_speed_median')}" if speed_median else ""
    lab = ", label" if labelled else ""
    return (f"{_features(view, weekly)} SELECT traj_id, {I('n', 'point_count')}, {I('backs', 'backtrack_count')}, "
            f"{cols}{more}{lab} FROM fx")


def feature_text_sql() -> str:
    """The text export as (trajectory, position, number): NaN is written as 0, the label comes last."""
    values = ["n", "backs", *[e for e, _ in _feature_exprs()], "CAST(label AS DOUBLE)"]
    listed = ", ".join(f"CAST({v} AS DOUBLE)" for v in values)
    return (f"{_features('B', True)}, long AS (SELECT traj_id, unnest([{listed}]) AS v, "
            f"generate_subscripts([{listed}], 1) - 1 AS position FROM fx) "
            f"SELECT traj_id, {I('position', 'position')}, {D('CASE WHEN isnan(v) THEN 0.0 ELSE v END', 'value')} FROM long")


PRED = ("pr AS (SELECT event_id AS traj_id, round(least(1.0, value / 100.0), 4) AS score, "
        "CASE WHEN round(least(1.0, value / 100.0), 4) < 0.5 THEN '0.0' ELSE '1.0' END AS label, "
        "CAST(event_id % 2 AS DOUBLE) AS truth FROM events)")


def oracle_sql() -> dict[str, str]:
    b = base()
    week = points_cte(weekly=True)
    q = {}
    xyt = f"{X('x', 'x')}, {X('y', 'y')}, {X('t', 't')}"
    aim = f"{X('ax', 'ax')}, {X('ay', 'ay')}"
    q["parse_labelled"] = f"WITH {week} SELECT traj_id, {I('pos', 'pos')}, {xyt}, {aim}, label FROM pts"
    q["parse_unlabelled"] = f"WITH {week} SELECT traj_id, {I('pos', 'pos')}, {xyt}, {aim} FROM pts"
    q["scan_labelled_text"], q["scan_unlabelled_text"] = q["parse_labelled"], q["parse_unlabelled"]
    q["scan_format_text"] = q["parse_labelled"]
    q["parse_points"] = f"WITH {points_cte('A', True)} SELECT traj_id, {I('pos', 'pos')}, {xyt} FROM pts"
    q["explode_points"] = f"WITH {week} SELECT traj_id, {I('pos', 'pos')}, {xyt} FROM pts"
    q["parse_quarantine"] = (f"WITH {week} SELECT traj_id, CASE WHEN count(*) = 13 THEN 'bad_point' END AS reason "
                             f"FROM pts GROUP BY traj_id")
    arg = "(value - 50.0) / 25.0"
    q["np_log1p"] = (f"SELECT {I('event_id', 'event_id')}, {X(arg, 'arg')}, {D(L(arg), 'log1p')} FROM events")
    raw = f"({L(arg)} - {L(f'({arg}) * -1.0')})"
    q["nan_to_num"] = f"SELECT {I('event_id', 'event_id')}, {D(raw, 'raw')}, {D(N2N(raw), 'clean')} FROM events"
    q["series_diff"] = (f"{b} SELECT a.traj_id, {I('a.i', 'i')}, {X('a.v', 'dx')}, {X('b.v', 'dy')} "
                        f"FROM ser a JOIN ser b ON a.traj_id = b.traj_id AND a.i = b.i "
                        f"AND a.sid = 'dx' AND b.sid = 'dy'")
    for k in ["step_distance_x", "time_delta"]:
        q[k] = series_sql(k, exact=True)
    for k in ["log_speed", "log_accel", "log_angle", "log_speed_diff",
              "log_accel_diff", "log_angle_diff", "aim_distance_diff"]:
        q[k] = series_sql(k)
    q["aim_distance_compat"] = series_sql("aim_distance")
    q["aim_distance"] = (f"{b} SELECT traj_id, {I('pos', 'i')}, "
                         f"{D('sqrt((x - ax) * (x - ax) + (y - ay) * (y - ay))', 'v')} FROM s5")
    # head / mid / tail of six series after nan_to_num; <= 3 values repeat 6 times
    q["head_mid_tail"] = (
        f"{b}, ls AS (SELECT traj_id, sid AS series, i, {N2N('v')} AS v, count(*) OVER (PARTITION BY traj_id, sid) AS m "
        f"FROM ser WHERE sid IN ('log_speed', 'log_accel', 'log_angle', 'log_speed_diff', 'log_accel_diff', 'log_angle_diff')), "
        f"rr AS (SELECT *, unnest(CASE WHEN m <= 3 THEN range(6) ELSE [0] END) AS r FROM ls), "
        f"rep AS (SELECT traj_id, series, CASE WHEN m <= 3 THEN r * m + i ELSE i END AS j, v, "
        f"CASE WHEN m <= 3 THEN 6 * m ELSE m END AS len FROM rr), "
        f"parts AS (SELECT traj_id, series, 'head' AS part, j AS i, v FROM rep WHERE j < 3 "
        f"UNION ALL SELECT traj_id, series, 'mid', j - (len // 2 - 2), v FROM rep WHERE j >= len // 2 - 2 AND j < len // 2 + 1 "
        f"UNION ALL SELECT traj_id, series, 'tail', j - (len - 3), v FROM rep WHERE j >= len - 3) "
        f"SELECT traj_id, series, part, {I('i', 'i')}, {D('v', 'v')} FROM parts")
    # linear forms: dx / dt and diff(dx) / guard(diff(dt)), zip-truncated
    q["linear_speed_accel"] = (
        f"{b}, dxs AS (SELECT traj_id, i, v FROM ser WHERE sid = 'dx'), "
        f"dts AS (SELECT traj_id, i, v FROM ser WHERE sid = 'time_delta'), "
        f"m AS (SELECT traj_id, count(*) AS k FROM dxs GROUP BY traj_id), "
        f"sp AS (SELECT a.traj_id, a.i, a.v / b.v AS v FROM dxs a JOIN dts b USING (traj_id, i)), "
        f"ddx AS (SELECT a.traj_id, a.i - 1 AS i, a.v - p.v AS v FROM dxs a JOIN dxs p "
        f"ON a.traj_id = p.traj_id AND p.i = a.i - 1 "
        f"UNION ALL SELECT traj_id, 0, v - v FROM dxs JOIN m USING (traj_id) WHERE k = 1), "
        f"ddt AS (SELECT a.traj_id, a.i - 1 AS i, {G('a.v - p.v')} AS v FROM dts a JOIN dts p "
        f"ON a.traj_id = p.traj_id AND p.i = a.i - 1 "
        f"UNION ALL SELECT traj_id, 0, {G('v - v')} FROM dts JOIN m USING (traj_id) WHERE k = 1), "
        f"ac AS (SELECT a.traj_id, a.i, a.v / b.v AS v FROM ddx a JOIN ddt b USING (traj_id, i)) "
        f"SELECT traj_id, 'speed' AS kind, {I('i', 'i')}, {D('v', 'v')} FROM sp "
        f"UNION ALL SELECT traj_id, 'accel', {I('i', 'i')}, {D('v', 'v')} FROM ac")
    for k in ["x", "y", "t", "time_delta", "log_speed", "log_accel", "log_angle", "aim_distance",
              "log_speed_diff", "log_accel_diff", "log_angle_diff", "aim_distance_diff"]:
        q[f"stats_{k}"] = stats_sql(k)
    q["point_count"] = f"{b} SELECT traj_id, {I('n', 'point_count')} FROM tr"
    q["backtrack_count"] = f"{base('A')} SELECT traj_id, {I('backs', 'backtrack_count')} FROM tr"
    cont = ", ".join(
        D(f"CASE WHEN n > 1 THEN sum(abs(d{c})) / n ELSE 0.0 END", f"c{c}") for c in "xyt")
    q["continuity"] = (f"{b}, dd AS (SELECT traj_id, n, x - x1 AS dx, y - y1 AS dy, t - t1 AS dt "
                       f"FROM s5) SELECT traj_id, {cont} FROM dd GROUP BY traj_id, n")
    q["final_offset"] = (f"{b} SELECT traj_id, {D('sqrt((xl - ax) * (xl - ax) + (yl - ay) * (yl - ay))', 'dis')}, "
                         f"{X('xl - ax', 'dx')}, {X('yl - ay', 'dy')} FROM tr")
    q["net_displacement"] = (f"{b} SELECT traj_id, {X('xl - x0', 'dx')}, {X('yl - y0', 'dy')}, "
                             f"{X('abs(tl - t0)', 'dt')} FROM tr")
    q["aim_angle"] = f"{b} SELECT traj_id, {D(L('y0 - ay') + ' - ' + L('x0 - ax'), 'aim_angle')} FROM tr"
    q["traj_count"] = "SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS traj_count FROM events"
    q["feature_matrix_train"] = feature_sql(weekly=True)
    q["feature_matrix_test"] = feature_sql(weekly=True, labelled=False)
    q["feature_text_export"] = feature_text_sql()
    bA = base("A")
    q["series_diff_long"] = (f"{bA} SELECT CAST(traj_id AS BIGINT) AS traj_id, {I('pos', 'pos')}, "
                             f"{X('dx', 'dx')}, {X('dy', 'dy')}, {X('dt', 'time_delta')} FROM s5")
    q["series_diff_stream"] = q["series_diff_long"]
    q["first_last_long"] = (f"{bA} SELECT CAST(traj_id AS BIGINT) AS traj_id, {I('n', 'point_count')}, "
                            f"{X('x0', 'x_first')}, {X('xl', 'x_last')}, {X('y0', 'y_first')}, "
                            f"{X('yl', 'y_last')}, {X('t0', 't_first')}, {X('tl', 't_last')} FROM tr")
    q["medians_by_counting"] = medians_sql()
    q["incremental_summaries"] = incremental_sql()
    q["feature_matrix_long"] = feature_sql("B", speed_median=True)
    q["feature_matrix_long_raw"] = feature_sql("A", speed_median=True)
    q["stats_long_log_angle"] = stats_sql("log_angle", "A")
    q["traj_preview"] = (f"WITH {points_cte()} SELECT traj_id, CAST(count(*) AS BIGINT) AS point_count "
                         f"FROM pts GROUP BY traj_id ORDER BY traj_id LIMIT 10")
    numbered = f"WITH {PRED}, o AS (SELECT *, row_number() OVER (ORDER BY traj_id) AS ordinal FROM pr)"
    q["scan_class_text"] = f"{numbered} SELECT {I('ordinal', 'ordinal')} FROM o WHERE label = '0.0'"
    q["scan_score_text"] = f"{numbered} SELECT {I('ordinal', 'ordinal')}, score FROM o WHERE score < 0.97"
    q["submission_text"] = f"{numbered} SELECT {I('ordinal', 'ordinal')} FROM o WHERE score < 0.97"
    q["submission_published"] = q["submission_text"]
    q["decide_by_class"] = f"WITH {PRED} SELECT traj_id FROM pr WHERE label = '0.0'"
    q["decide_by_score"] = f"WITH {PRED} SELECT traj_id FROM pr WHERE score < 0.97"
    q["flagged_count"] = f"WITH {PRED} SELECT CAST(count(*) AS BIGINT) AS flagged FROM pr WHERE score < 0.97"
    q["submission_ordinal"] = (f"WITH {PRED}, o AS (SELECT label, row_number() OVER (ORDER BY traj_id) AS ordinal "
                               f"FROM pr) SELECT CAST(ordinal AS BIGINT) AS ordinal FROM o WHERE label = '0.0'")
    q["join_predictions"] = (
        "WITH us AS (SELECT user_id AS traj_id, least(1.0, floor(sum(CAST(round(value * 100) AS BIGINT)) "
        "/ count(*)) / 10000.0) AS score FROM events GROUP BY user_id), uc AS (SELECT user_id AS traj_id, count(*) AS point_count "
        "FROM events GROUP BY user_id) "
        f"SELECT traj_id, {D('score', 'score')}, {I('point_count', 'point_count')}, "
        "score < 0.97 AS flagged, 'both' AS matched FROM us JOIN uc USING (traj_id)")
    q["join_predictions_bucketed"] = q["join_predictions"]
    q["class_weights"] = ("SELECT DISTINCT user_id AS traj_id, CAST(user_id % 2 AS DOUBLE) AS label, "
                          "CASE WHEN user_id % 2 = 1 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM events")
    # Trees that split on the one deciding feature: every margin is f or -f, and f grows by the step times the gradient
    # of the log loss. ``pull`` is the gradient that the tree of a round fits (the first one fits the classes).
    margins = ("m(round, f, pull) AS (SELECT 1, 1.0::DOUBLE, 1.0::DOUBLE UNION ALL "
               "SELECT round + 1, f + 0.02 * 4.0 / (1.0 + exp(2.0 * f)), 4.0 / (1.0 + exp(2.0 * f)) FROM m WHERE round < 10)")
    classes = "cl AS (SELECT traj_id, count(*) >= 14 AS yes FROM pts GROUP BY traj_id)"
    fraction = "('0x' || substr(md5(traj_id || ':' || {} || ':42'), 1, 8))::BIGINT / 4294967296.0"
    q["gbt_train_predict"] = (
        f"WITH RECURSIVE {week}, {classes}, {margins} SELECT traj_id, CASE WHEN yes THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, "
        f"{D('1.0 / (1.0 + exp(CASE WHEN yes THEN -2.0 ELSE 2.0 END * f))', 'score')} FROM cl JOIN m ON round = 10")
    q["train_rounds"] = (
        f"WITH RECURSIVE {week}, {classes}, {margins}, rest AS (SELECT * FROM cl WHERE {fraction.format('-1')} < 0.2) "
        f"SELECT {I('round', 'round')}, {I('(SELECT count(*) FROM rest)', 'n')}, {D('ln(1.0 + exp(-2.0 * f))', 'logloss')}, "
        "1.0::DOUBLE AS auc FROM m")
    q["training_sample"] = (f"WITH {week} SELECT DISTINCT {I('r', 'round')}, traj_id FROM pts, (SELECT unnest(range(10)) AS r) "
                            f"WHERE {fraction.format('r')} < 0.6")
    counts = "SELECT count(*) FILTER (yes) AS a, count(*) FILTER (NOT yes) AS b FROM cl"
    tree = "CAST(round - 1 AS BIGINT) AS tree, CASE WHEN round = 1 THEN 1.0::DOUBLE ELSE 0.02::DOUBLE END AS tree_weight"
    leaf = "CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS BIGINT) AS \"left\", CAST(NULL AS BIGINT) AS \"right\""
    q["tree_table"] = (
        f"WITH RECURSIVE {week}, {classes}, {margins}, k AS ({counts}) "
        f"SELECT {tree}, {I('0', 'node')}, 'point_count' AS feature, 13.5::DOUBLE AS threshold, {I('1', chr(34) + 'left' + chr(34))}, "
        f"{I('2', chr(34) + 'right' + chr(34))}, {I('a + b', 'n_rows')}, {D('pull * (10 * a - b) / (10 * a + b)', 'prediction')} FROM m, k "
        f"UNION ALL BY NAME SELECT {tree}, {I('1', 'node')}, {leaf}, {I('b', 'n_rows')}, {D('-pull', 'prediction')} FROM m, k "
        f"UNION ALL BY NAME SELECT {tree}, {I('2', 'node')}, {leaf}, {I('a', 'n_rows')}, {D('pull', 'prediction')} FROM m, k")
    names = [f for f in FEATURE_ORDER if f != "log_speed_mean_dup"] + ["log_speed_median"]
    q["feature_importance"] = (f"SELECT feature, CASE WHEN feature = 'point_count' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
                               f"AS importance FROM (SELECT unnest({names}) AS feature)")
    machines = "nullif(total - humans, 0)"
    q["threshold_curve"] = (
        f"WITH {PRED}, h AS (SELECT CAST(least(greatest(floor(score * 1000), 0), 999) AS BIGINT) AS bin, count(*) AS n, "
        "count(*) FILTER (truth = 1) AS pos FROM pr WHERE score IS NOT NULL GROUP BY 1), "
        "c AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS flagged, sum(pos) OVER (ORDER BY bin) AS human, "
        "sum(n) OVER () AS total, sum(pos) OVER () AS humans FROM h) "
        f"SELECT {D('(bin + 1) / 1000.0::DOUBLE', 'threshold')}, {I('flagged', 'flagged')}, {D('flagged / total', 'flagged_share')}, "
        f"{D(f'(flagged - human) / {machines}', 'tpr')}, {D('human / nullif(humans, 0)', 'fpr')}, "
        f"{D('(flagged - human) / flagged', 'precision')} FROM c")
    q["eval_auc"] = (
        f"WITH {PRED}, g AS (SELECT score, sum(CASE WHEN truth = 1 THEN 1 ELSE 0 END) AS p, count(*) AS c "
        "FROM pr GROUP BY score), r AS (SELECT *, sum(c) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND CURRENT ROW) - (c - 1) / 2.0 AS mr FROM g), "
        "t AS (SELECT sum(p * mr) AS rs, sum(p) AS p, sum(c) - sum(p) AS n FROM r) "
        f"SELECT {D('(rs - p * (p + 1) / 2.0) / (p * n)', 'auc')} FROM t")
    pc = "least(greatest(score, 1e-15), 1.0 - 1e-15)"
    q["eval_logloss"] = (f"WITH {PRED} SELECT {D(f'-avg(truth * ln({pc}) + (1.0 - truth) * ln(1.0 - {pc}))', 'logloss')} "
                         "FROM pr")
    return q
