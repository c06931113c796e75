"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the driver tables; trajectories come from ``events``
(:mod:`trailfeat.sources.events`). Series, summary, count and matrix queries run
on whole users in long form. The text queries read trajectory lines, one per user
and calendar week, through the parser, as the reference's input does.

Outputs are flat: series are rows ``(traj_id, i, value)``. Exact values
(coordinates, times, their differences, counts, copied values) are returned as
they are; inexact statistics are passed through :func:`settle` so results compare
across engines (the library functions themselves return full precision).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import stats as A
from ..functions.mathx import nan_to_num, np_log1p, settle_expr
from ..operators import decide as D
from ..operators import evaluate as EV
from ..operators import features as FT
from ..operators import longform as LF
from ..operators import parse as P
from ..operators.median import counting_medians
from ..session import scratch_path
from ..sources import events as E
from ..sources import sinks
from ..sources import text as TX
from ..sources.bucketed import buckets_for, join_bucketed, write_bucketed
from ..sources.formats import register
from ..sources.publish import read_published
from ..streaming.step_stream import start_step_stream
from .jobs import submission_job

POINT = ("x", "y", "t", "ax", "ay")
#: Summary fields that copy a value of the series, and series whose values are exact.
COPIED = ("first", "last", "max", "min")
EXACT_SERIES = ("x", "y", "t", "time_delta")
EXACT_FEATURES = tuple(f"{v}_{k}" for v in EXACT_SERIES for k in COPIED) + ("final_dx", "final_dy")


def settled(df: DataFrame, exact=()) -> DataFrame:
    """Round doubles other than ``exact`` (see ``settle``) and widen integers to long.

    Wide outputs (the 70-feature matrices) evaluate the rounding inside a
    lambda so the comparison wrapper does not push the generated code of the
    final stage over the JVM's 64 KB method limit.
    """
    doubles = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    wide = len(doubles) > 16
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exact:
            cols.append(settle_expr(f.name, bind=wide).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- inputs

def lines(spark, sf, labelled=True, view="B", corrupt=False) -> DataFrame:
    return E.trajectory_lines(spark, sf, labelled=labelled, view=view, corrupt=corrupt)


def trajs(spark, sf, labelled=True, view="B") -> DataFrame:
    return P.good(P.parse_trajectories(lines(spark, sf, labelled, view), labelled=labelled))


def steps(spark, sf, view="B") -> DataFrame:
    """Whole users with every step series, and ``n``."""
    return LF.step_series(E.lagged_points(spark, sf, view, with_count=True))


def points(spark, sf, view="B") -> DataFrame:
    return E.lagged_points(spark, sf, view, lags=1)


def summaries_of(spark, sf, view, fn, **kw) -> DataFrame:
    """``fn(steps, heavy=..., heavy_steps=...)`` with the heavy users read off the event table itself."""
    heavy = LF.heavy_keys(E.events(spark, sf).select(F.col("user_id").alias("traj_id")))
    long = None if heavy is None else LF.step_series(E.lagged_points(spark, sf, view, users=heavy))
    return fn(LF.step_series(E.lagged_points(spark, sf, view)), heavy=heavy, heavy_steps=long, **kw)


# ---------------------------------------------------------------- parse

def _points_of(t: DataFrame, labelled: bool) -> DataFrame:
    keep = ("traj_id", "aim") + (("label",) if labelled else ())
    return settled(P.explode_points(t, keep=keep).select(
        "traj_id", "pos", "x", "y", "t", F.col("aim.ax").alias("ax"), F.col("aim.ay").alias("ay"),
        *(["label"] if labelled else [])), POINT)


def q_parse_labelled(spark, sf):
    return _points_of(trajs(spark, sf, labelled=True), True)


def q_parse_unlabelled(spark, sf):
    return _points_of(trajs(spark, sf, labelled=False), False)


def _scan_text(labelled: bool):
    def q(spark, sf):
        path = scratch_path(spark, "lines")
        lines(spark, sf, labelled).write.text(path)
        return _points_of(P.good(TX.read_trajectories(spark, path, labelled=labelled)), labelled)
    return q


def q_scan_format_text(spark, sf):
    """The labelled lines through the named format."""
    path = scratch_path(spark, "lines")
    lines(spark, sf).write.text(path)
    register(spark)
    return _points_of(P.good(spark.read.format("trajectories").load(path)), True)


def q_parse_points(spark, sf):
    """The point-list parser alone, on view-A lines (large, exponent-formatted t)."""
    ln = lines(spark, sf, view="A")
    f = F.split("value", " ", -1)
    pts = ln.select(F.get(f, 0).alias("traj_id"), P.parse_point_list(F.get(f, 1)).alias("points"))
    return settled(P.explode_points(pts), POINT)


def q_parse_quarantine(spark, sf):
    p = P.parse_trajectories(lines(spark, sf, corrupt=True))
    return p.select("traj_id", "reason")


def q_explode_points(spark, sf):
    return settled(P.explode_points(E.calendar_trajectories(spark, sf)), POINT)


# ---------------------------------------------------------------- maths

def _math_arg(spark, sf):
    ev = E.table(spark, sf, "events")
    return ev.select("event_id", ((F.col("value") - 50.0) / 25.0).alias("arg"))


def q_np_log1p(spark, sf):
    a = _math_arg(spark, sf)
    return settled(a.select("event_id", "arg", np_log1p("arg").alias("log1p")), ("arg",))


def q_nan_to_num(spark, sf):
    a = _math_arg(spark, sf)
    v = np_log1p("arg") - np_log1p(F.col("arg") * -1.0)
    return settled(a.select("event_id", v.alias("raw"), nan_to_num(v).alias("clean")))


# ---------------------------------------------------------------- series (whole users)

def q_series_diff(spark, sf):
    dy = F.when(F.col("pos") >= 1, F.col("dy")).otherwise(F.col("y") - F.col("y")).alias("dy")
    return LF.series_rows(steps(spark, sf), "dx", "traj_id", dy).select("traj_id", "i", F.col("v").alias("dx"), "dy")


def _series_key(name):
    def q(spark, sf):
        return settled(LF.series_rows(steps(spark, sf), name), ("v",) if name in ("step_distance_x", "time_delta") else ())
    q.__name__ = f"q_{name}"
    return q


def q_aim_distance(spark, sf):
    return settled(LF.aim_distance_rows(points(spark, sf)))


def q_aim_distance_compat(spark, sf):
    pair = LF.aim_distance_pairs(points(spark, sf))
    return settled(pair.select("traj_id", F.posexplode(F.array("aim0", "aim1")).alias("i", "v")))


def q_aim_distance_diff(spark, sf):
    pair = LF.aim_distance_pairs(points(spark, sf))
    return settled(pair.select("traj_id", F.lit(0).alias("i"), (F.col("aim1") - F.col("aim0")).alias("v")))


def q_head_mid_tail(spark, sf):
    return settled(LF.head_mid_tail_rows(steps(spark, sf)))


def q_linear_speed_accel(spark, sf):
    return settled(LF.linear_rows(steps(spark, sf)))


# ---------------------------------------------------------------- summaries (whole users)

def _stats_key(name):
    def q(spark, sf):
        exact = COPIED if name in EXACT_SERIES else ()
        if name.startswith("aim_distance"):
            pair = LF.aim_distance_pairs(points(spark, sf))
            values = F.array("aim0", "aim1") if name == "aim_distance" else F.array(F.col("aim1") - F.col("aim0"))
            return settled(pair.select("traj_id", A.summary(values).alias("s")).select("traj_id", "s.*"))
        s = summaries_of(spark, sf, "B", LF.trajectory_summaries, medians=[name])
        return settled(s.select("traj_id", *[F.col(f"{name}_{k}").alias(k) for k in A.STATS]), exact)
    q.__name__ = f"q_stats_{name}"
    return q


def q_medians_by_counting(spark, sf):
    """Medians of every series of every user, long or short, by counting selection."""
    names = ["x", "y", "t", *LF.STEP_SERIES]
    steps = LF.step_series(E.lagged_points(spark, sf))
    stacked = steps.selectExpr("traj_id", "inline(array(" + ", ".join(
        f"named_struct('series', '{v}', 'v', CAST({v} AS DOUBLE))" for v in names) + "))")
    return settled(counting_medians(stacked, ["traj_id", "series"]))


def q_incremental_summaries(spark, sf):
    """Statistics of every series from a state that grew in three parts of the time, each read once."""
    from ..operators import incremental as INC
    stored = scratch_path(spark, "points")  # a point table as days would be added to it
    E.lagged_points(spark, sf, lags=1).select("traj_id", "pos", "ts", "x", "y", "t").write.parquet(stored)
    pts = spark.read.parquet(stored)
    state, cuts = None, ["1900-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        part = pts.where((F.col("ts") >= low) & (F.col("ts") < high)).drop("ts")
        path = scratch_path(spark, "trajectory-state")
        INC.updated(state, part).write(path)
        state = INC.read_state(spark, path)
    return settled(INC.summaries(state).drop("median"))


def q_point_count(spark, sf):
    return E.events(spark, sf).groupBy(F.col("user_id").alias("traj_id")).agg(F.count(F.lit(1)).alias("point_count"))


def q_backtrack_count(spark, sf):
    back = F.sum(F.when(F.col("dx") < 0, 1).otherwise(0)).cast("long")
    return LF.step_series(points(spark, sf, "A")).groupBy("traj_id").agg(back.alias("backtrack_count"))


def q_continuity(spark, sf):
    return settled(LF.continuity(points(spark, sf)))


def q_final_offset(spark, sf):
    return settled(LF.final_offset(points(spark, sf)), ("dx", "dy"))


def q_net_displacement(spark, sf):
    return settled(LF.net_displacement(points(spark, sf)), ("dx", "dy", "dt"))


def q_aim_angle(spark, sf):
    return settled(LF.aim_angle(points(spark, sf)))


def q_traj_count(spark, sf):
    return E.events(spark, sf).agg(F.countDistinct("user_id").alias("traj_count"))


# ---------------------------------------------------------------- feature matrix

def q_feature_matrix_train(spark, sf):
    return settled(FT.feature_matrix(trajs(spark, sf, labelled=True), labelled=True), EXACT_FEATURES)


def q_feature_matrix_test(spark, sf):
    return settled(FT.feature_matrix(trajs(spark, sf, labelled=False), labelled=False), EXACT_FEATURES)


def q_feature_text_export(spark, sf):
    """The feature text written, read back as text and split into numbers."""
    path = scratch_path(spark, "feature-text")
    sinks.write_feature_text(FT.feature_matrix(trajs(spark, sf)), path, with_id=True)
    parts = F.split("value", " ", -1)
    numbers = F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda v: v.cast("double"))
    back = spark.read.text(path).select(F.get(parts, 0).alias("traj_id"), F.posexplode(numbers).alias("position", "value"))
    return settled(back)


def _matrix(spark, sf, view):
    fm = summaries_of(spark, sf, view, LF.feature_matrix_long, with_speed_median=True)
    return settled(fm, EXACT_FEATURES)


def q_feature_matrix_long(spark, sf):
    return _matrix(spark, sf, "B")


def q_feature_matrix_long_raw(spark, sf):
    return _matrix(spark, sf, "A")


def q_series_diff_long(spark, sf):
    lp = LF.step_series(points(spark, sf, "A"))
    return lp.select("traj_id", "pos", "dx", "dy", "time_delta")


def q_series_diff_stream(spark, sf):
    """``series_diff_long`` from a stream: the points arrive in three parts, and the stream is restarted for each."""
    root = scratch_path(spark, "step-stream")
    E.lagged_points(spark, sf, "A", lags=1).select("traj_id", "ts", "event_id", "x", "y", "t").write.parquet(f"{root}/points")
    pts = spark.read.parquet(f"{root}/points")
    cuts = pts.agg(F.percentile_approx("ts", [1 / 3, 2 / 3]).alias("c")).first()["c"]
    ts, edges = F.col("ts"), [F.lit(c) for c in cuts or []]
    parts = [ts < edges[0], (ts >= edges[0]) & (ts < edges[1]), ts >= edges[1]] if edges else [F.lit(True)]
    for i, part in enumerate(parts):
        pts.where(part).write.parquet(f"{root}/in/part-{i}")
        start_step_stream(spark, f"{root}/in", pts.schema, f"{root}/out", f"{root}/late", f"{root}/state",
                          available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("traj_id", "pos", "dx", "dy", "time_delta")


def q_first_last_long(spark, sf):
    """First and last values (W2) in one aggregate, ordered by time and event id in one number."""
    ev = E.events(spark, sf)
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").cast("decimal(19,0)")
    at = (micros * F.lit(10 ** 18).cast("decimal(19,0)") + F.col("event_id")).cast("decimal(38,0)")
    g = ev.withColumn("at", at).groupBy(F.col("user_id").alias("traj_id")).agg(
        F.count(F.lit(1)).alias("point_count"), F.min_by("value", "at").alias("x_first"),
        F.max_by("value", "at").alias("x_last"), F.min_by(F.col("k").cast("double"), "at").alias("y_first"),
        F.max_by(F.col("k").cast("double"), "at").alias("y_last"), F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    return g.select("traj_id", "point_count", "x_first", "x_last", "y_first", "y_last", F.lit(0.0).alias("t_first"),
                    E.whole_ms("_t0", "_t1").alias("t_last"))


def q_stats_long_log_angle(spark, sf):
    s = summaries_of(spark, sf, "A", LF.trajectory_summaries, medians=["log_angle"])
    return settled(s.select("traj_id", *[F.col(f"log_angle_{k}").alias(k) for k in A.STATS]))


# ---------------------------------------------------------------- decisions

def q_traj_preview(spark, sf):
    return D.preview(q_point_count(spark, sf), 10)


def q_decide_by_class(spark, sf):
    return D.by_class(E.predictions(spark, sf)).select("traj_id")


def q_decide_by_score(spark, sf):
    return D.by_score(E.predictions(spark, sf)).select("traj_id")


def _prediction_text(spark, sf, kind: str) -> str:
    """Prediction lines in the order of their ids, written to the shared folder."""
    path = scratch_path(spark, f"predictions-{kind}")
    p = E.predictions(spark, sf)
    value = F.col("label") if kind == "class" else F.concat_ws("\t", F.col("traj_id").cast("string"), F.col("score").cast("string"))
    p.orderBy("traj_id").select(value.alias("value")).write.text(path)
    return path


def q_scan_class_text(spark, sf):
    preds = TX.line_numbers(TX.read_class_predictions(spark, _prediction_text(spark, sf, "class")))
    return D.by_class(preds).select("ordinal")


def q_scan_score_text(spark, sf):
    preds = TX.line_numbers(TX.read_score_predictions(spark, _prediction_text(spark, sf, "score")))
    return D.by_score(preds).select("ordinal", "score")


def q_submission_text(spark, sf):
    """From prediction text to the submission file, read back as text."""
    out = scratch_path(spark, "submission")
    submission_job(spark, _prediction_text(spark, sf, "score"), out, kind="score")
    return spark.read.text(out).select(F.col("value").cast("long").alias("ordinal"))


def q_submission_published(spark, sf):
    """The class submission published first, then the score submission over it; the newest is read."""
    out = scratch_path(spark, "published")
    for kind in ("class", "score"):
        submission_job(spark, _prediction_text(spark, sf, kind), out, kind=kind, sink_mode="publish")
    return read_published(spark, out).select(F.col("value").cast("long").alias("ordinal"))


def q_flagged_count(spark, sf):
    return D.flagged_count(D.by_score(E.predictions(spark, sf)))


def q_submission_ordinal(spark, sf):
    return D.submission_ordinals(E.predictions(spark, sf), order=("traj_id",))


def q_join_predictions(spark, sf):
    preds = D.user_scores(E.table(spark, sf, "events"))
    return settled(D.join_predictions(preds, q_point_count(spark, sf)))


def q_join_predictions_bucketed(spark, sf):
    """The same join on two bucketed tables: it exchanges nothing."""
    preds, counts = D.user_scores(E.table(spark, sf, "events")), q_point_count(spark, sf)
    buckets = buckets_for(preds.count())
    tables = {}
    for name, df in (("scores", preds), ("counts", counts)):
        path = scratch_path(spark, name)
        tables[name] = path.rsplit("/", 1)[1].replace("-", "_")
        write_bucketed(df, tables[name], buckets=buckets, path=path)
    joined = settled(join_bucketed(spark, tables["scores"], tables["counts"]))
    for t in tables.values():  # the files stay, the names are of no further use
        spark.sql(f"DROP TABLE {t}")
    return joined


# ---------------------------------------------------------------- evaluation / model

def q_class_weights(spark, sf):
    users = E.events(spark, sf).select("user_id").distinct()
    labels = users.select(F.col("user_id").alias("traj_id"), *E.target_cols(F.col("user_id"))).select(
        "traj_id", F.col("label").cast("double").alias("label"))
    return EV.class_weights(labels)


def q_eval_auc(spark, sf):
    return settled(EV.auc(E.predictions(spark, sf), score="score", label="truth"))


def q_eval_logloss(spark, sf):
    return settled(EV.logloss(E.predictions(spark, sf), score="score", label="truth"))


#: Points from which on a trajectory of the training fixture has label 1.
LABEL_POINTS = 14


def _learnable(spark, sf) -> DataFrame:
    """Features with a label that one feature decides: every class is known beforehand."""
    fm = FT.feature_matrix(trajs(spark, sf), with_speed_median=True)
    return fm.withColumn("label", (F.col("point_count") >= LABEL_POINTS).cast("int").cast("string"))


def q_gbt_train_predict(spark, sf):
    from ..operators import model as M
    return settled(M.train_predict(_learnable(spark, sf)).select("traj_id", "score", "prediction"))


def q_gbt_train_predict_label(spark, sf):
    """The same on the fixture's own label, which no feature decides."""
    from ..operators import model as M
    return M.train_predict(FT.feature_matrix(trajs(spark, sf), with_speed_median=True)).select("traj_id", "score", "prediction")


def q_feature_importance(spark, sf):
    from ..operators import model as M
    return settled(M.feature_importance(_learnable(spark, sf)))


#: Share of the rows that are held out to measure each round, and that a sampled round sees.
HELD_OUT, ROW_SHARE = 0.2, 0.6


def q_train_rounds(spark, sf):
    from ..operators import boosting as B
    from ..operators import model as M
    train, rest = B.held_out(_learnable(spark, sf), HELD_OUT)
    return settled(B.round_metrics(B.as_boosted(M.fit(train)), rest))


def q_training_sample(spark, sf):
    """The rows that each of ten rounds of a sampled training sees."""
    from ..operators.sampling import in_sample
    rounds = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("round")
    return trajs(spark, sf).select("traj_id", rounds).where(in_sample(F.col("traj_id"), ROW_SHARE, F.col("round"))).select(
        F.col("round").cast("long").alias("round"), "traj_id")


def q_sampled_train_predict(spark, sf):
    """Boosting in which every round sees its own sample of rows and columns."""
    from ..operators import boosting as B
    features = _learnable(spark, sf)
    return B.predict(B.fit_rounds(features, rounds=5, row_share=ROW_SHARE, column_share=0.5), features)


def q_tree_table(spark, sf):
    from ..operators import model as M
    from ..operators import trees as TR
    from ..operators.features import ml_feature_names
    features, path = _learnable(spark, sf), scratch_path(spark, "model")
    M.fit(features).write().save(path)
    nodes = TR.tree_nodes(spark, path, ml_feature_names(features.columns))
    return settled(nodes.select("tree", "node", "feature", "threshold", "n_rows", "prediction", "left", "right", "tree_weight"),
                   ("threshold", "tree_weight"))


def q_threshold_curve(spark, sf):
    return settled(EV.threshold_curve(EV.score_histogram(E.predictions(spark, sf), label="truth")))


SERIES_KEYS = ["step_distance_x", "time_delta", "log_speed", "log_accel", "log_angle", "log_speed_diff",
               "log_accel_diff", "log_angle_diff"]
STATS_KEYS = ["x", "y", "t", "time_delta", "log_speed", "log_accel", "log_angle", "aim_distance",
              "log_speed_diff", "log_accel_diff", "log_angle_diff", "aim_distance_diff"]


def queries() -> dict:
    q = {
        "parse_labelled": q_parse_labelled,
        "parse_unlabelled": q_parse_unlabelled,
        "parse_points": q_parse_points,
        "parse_quarantine": q_parse_quarantine,
        "scan_labelled_text": _scan_text(True),
        "scan_unlabelled_text": _scan_text(False),
        "scan_format_text": q_scan_format_text,
        "explode_points": q_explode_points,
        "np_log1p": q_np_log1p,
        "nan_to_num": q_nan_to_num,
        "series_diff": q_series_diff,
    }
    for k in SERIES_KEYS:
        q[k] = _series_key(k)
    q["aim_distance_diff"] = q_aim_distance_diff
    q["aim_distance_compat"] = q_aim_distance_compat
    q["aim_distance"] = q_aim_distance
    q["head_mid_tail"] = q_head_mid_tail
    q["linear_speed_accel"] = q_linear_speed_accel
    for k in STATS_KEYS:
        q[f"stats_{k}"] = _stats_key(k)
    q.update({
        "medians_by_counting": q_medians_by_counting,
        "incremental_summaries": q_incremental_summaries,
        "point_count": q_point_count,
        "backtrack_count": q_backtrack_count,
        "continuity": q_continuity,
        "final_offset": q_final_offset,
        "net_displacement": q_net_displacement,
        "aim_angle": q_aim_angle,
        "traj_count": q_traj_count,
        "feature_matrix_train": q_feature_matrix_train,
        "feature_matrix_test": q_feature_matrix_test,
        "feature_text_export": q_feature_text_export,
        "series_diff_long": q_series_diff_long,
        "series_diff_stream": q_series_diff_stream,
        "first_last_long": q_first_last_long,
        "feature_matrix_long": q_feature_matrix_long,
        "feature_matrix_long_raw": q_feature_matrix_long_raw,
        "stats_long_log_angle": q_stats_long_log_angle,
        "traj_preview": q_traj_preview,
        "decide_by_class": q_decide_by_class,
        "decide_by_score": q_decide_by_score,
        "scan_class_text": q_scan_class_text,
        "scan_score_text": q_scan_score_text,
        "submission_text": q_submission_text,
        "submission_published": q_submission_published,
        "flagged_count": q_flagged_count,
        "submission_ordinal": q_submission_ordinal,
        "join_predictions": q_join_predictions,
        "join_predictions_bucketed": q_join_predictions_bucketed,
        "class_weights": q_class_weights,
        "eval_auc": q_eval_auc,
        "eval_logloss": q_eval_logloss,
        "gbt_train_predict": q_gbt_train_predict,
        "gbt_train_predict_label": q_gbt_train_predict_label,
        "feature_importance": q_feature_importance,
        "train_rounds": q_train_rounds,
        "training_sample": q_training_sample,
        "sampled_train_predict": q_sampled_train_predict,
        "tree_table": q_tree_table,
        "threshold_curve": q_threshold_curve,
    })
    return q
