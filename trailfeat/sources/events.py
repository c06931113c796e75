"""Trajectories derived from the ``events`` table.

One trajectory per ``user_id``; points in ``(ts, event_id)`` order.

* View ``A`` (raw):        x = value, y = props.k, t = whole ms since the
  user's first event.
* View ``B`` (cumulative): running sums in the same order,
  x = sum(round(value*100))/100, y = sum(k), t = sum(event_id % 3)
  (integer sums, so exact).

Target and label: ax = (user_id*7) % 500, ay = (user_id*3) % 100,
label = user_id % 2 (as text).

Every view is built with the skew-safe ordered scan of
:mod:`trailfeat.plans.sequence`, so a user holding a third of all events is
spread over many tasks. The lag columns of view B come from the same single
pass: the sum up to the previous row is the running sum minus the row's own
increment.

The text form holds a whole trajectory in one line, as the reference's input
does. There a trajectory is what a user did in one calendar unit (a week unless
given), a boundary that lies in the data; no point is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import format_points
from ..plans.sequence import sequence

ORDER = ["ts", "event_id"]
#: Calendar unit that bounds a trajectory of the text form (``week``, ``month``, ``year``).
TEXT_UNIT = "week"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, ts, user_id, value, k`` (k from the JSON properties)."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"))


def target_cols(user: Column) -> list[Column]:
    return [((user * 7) % 500).cast("double").alias("ax"),
            ((user * 3) % 100).cast("double").alias("ay"),
            (user % 2).cast("string").alias("label")]


def whole_ms(start: str, end: str) -> Column:
    """Whole milliseconds between two timestamps."""
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end}) div 1000").cast("double")


def lagged_points(spark: SparkSession, sf_dir: str, view: str = "B",
                  lags: int = 2, with_count: bool = False, users: DataFrame | None = None) -> DataFrame:
    """``traj_id, event_id, ts, pos, x, y, t, x_lag1.., y_lag.., t_lag.., ax, ay, label[, n]``.

    One row per event; ``*_lagj`` is NULL when the point has no j-th
    predecessor. ``traj_id`` is the user id; ``n`` the trajectory's points. ``users``
    (a few ``traj_id``) restricts the users before anything else is done.
    """
    ev = events(spark, sf_dir)
    if users is not None:
        ev = ev.join(users.select(F.col("traj_id").alias("user_id")), "user_id", "left_semi")
    u = F.col("user_id")
    if view == "A":
        s = sequence(ev, ["user_id"], ORDER, lag_cols=["value", "k", "ts"], lags=lags,
                     first_cols=["ts"], with_count=with_count)
        cols = [F.col("value").alias("x"), F.col("k").cast("double").alias("y"), whole_ms("ts_first", "ts").alias("t")]
        for j in range(1, lags + 1):
            cols += [F.col(f"value_lag{j}").alias(f"x_lag{j}"),
                     F.col(f"k_lag{j}").cast("double").alias(f"y_lag{j}"),
                     whole_ms("ts_first", f"ts_lag{j}").alias(f"t_lag{j}")]
    elif view == "B":
        inc = ev.select("event_id", "ts", "user_id",
                        F.round(F.col("value") * 100).cast("long").alias("xi"),
                        F.col("k").alias("yi"), (F.col("event_id") % 3).alias("ti"))
        # lag j of a running sum = sum - increments of the last j rows, so the
        # scan only needs increment lags up to j - 1
        s = sequence(inc, ["user_id"], ORDER,
                     lag_cols=["xi", "yi", "ti"] if lags >= 2 else [], lags=lags - 1,
                     sum_cols=["xi", "yi", "ti"], with_count=with_count)
        scale = {"x": 100.0, "y": 1.0, "t": 1.0}
        cols = []
        for a, i in (("x", "xi"), ("y", "yi"), ("t", "ti")):
            cum = F.col(f"{i}_cum")
            cols.append((cum / scale[a]).alias(a))
            back = cum - F.col(i)               # sum up to the previous row
            cols.append(F.when(F.col("pos") >= 1, back / scale[a]).alias(f"{a}_lag1"))
            for j in range(2, lags + 1):
                back = back - F.col(f"{i}_lag{j - 1}")
                cols.append(F.when(F.col("pos") >= j, back / scale[a]).alias(f"{a}_lag{j}"))
    else:
        raise ValueError(f"unknown view {view!r}")
    return s.select(u.alias("traj_id"), "event_id", "ts", "pos", *cols, *target_cols(u),
                    *([F.col("seq_n").alias("n")] if with_count else []))


def points(spark: SparkSession, sf_dir: str, view: str = "B") -> DataFrame:
    """``traj_id, pos, x, y, t`` (no lags)."""
    return lagged_points(spark, sf_dir, view, lags=1).select("traj_id", "pos", "x", "y", "t")


def calendar_trajectories(spark: SparkSession, sf_dir: str, view: str = "B", unit: str = TEXT_UNIT) -> DataFrame:
    """Array-form trajectories ``traj_id, points, aim, label``: a user's points of one calendar unit.

    ``traj_id = '<user>-<first day of the unit as yyyymmdd>'``.
    """
    p = lagged_points(spark, sf_dir, view, lags=1)
    day = F.translate(F.trunc(F.to_date("ts"), unit).cast("string"), "-", "")
    g = p.select(F.concat_ws("-", F.col("traj_id").cast("string"), day).alias("traj_id"),
                 "pos", "x", "y", "t", "ax", "ay", "label")
    return (g.groupBy("traj_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y", "t"))).alias("_p"),
                 F.first("ax").alias("ax"), F.first("ay").alias("ay"), F.first("label").alias("label"))
            .select("traj_id",
                    F.transform("_p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"),
                                                         q["t"].alias("t"))).alias("points"),
                    F.struct("ax", "ay").alias("aim"), "label"))


def trajectory_lines(spark: SparkSession, sf_dir: str, labelled: bool = True, view: str = "B",
                     corrupt: bool = False) -> DataFrame:
    """Text lines ``id x,y,t;...; ax,ay [label]`` of the calendar trajectories.

    With ``corrupt`` the first y of a trajectory with exactly 13 points is replaced
    by the token ``a`` (quarantine fixture).
    """
    tr = calendar_trajectories(spark, sf_dir, view)
    body = format_points("points")
    if corrupt:
        first = F.col("points")[0]
        bad_first = F.concat_ws(",", first["x"].cast("string"), F.lit("a"), first["t"].cast("string"))
        rest = F.slice("points", 2, F.greatest(F.size("points") - 1, F.lit(0)))
        bad_body = F.concat(bad_first, F.lit(";"),
                            F.when(F.size(rest) > 0, format_points(rest)).otherwise(F.lit("")))
        body = F.when(F.size("points") == 13, bad_body).otherwise(body)
    tgt = F.concat_ws(",", F.col("aim.ax").cast("string"), F.col("aim.ay").cast("string"))
    parts = [F.col("traj_id"), body, tgt] + ([F.col("label")] if labelled else [])
    return tr.select(F.concat_ws(" ", *parts).alias("value"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction fixture: ``traj_id (event_id), score, label (class text), truth``."""
    ev = table(spark, sf_dir, "events")
    score = F.round(F.least(F.lit(1.0), F.col("value") / 100.0), 4)
    return ev.select(F.col("event_id").alias("traj_id"), score.alias("score"),
                     F.when(score < 0.5, F.lit("0.0")).otherwise(F.lit("1.0")).alias("label"),
                     (F.col("event_id") % 2).cast("double").alias("truth"))
