"""The 70-feature matrix (array form), its ML variant and the text export.

Input: a parsed trajectory table (``traj_id, points, aim, [label]``), one row
per trajectory. The whole assembly is one ``select`` chain of native
expressions: no shuffle, no Python.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import series as S
from ..functions import stats as A
from ..functions.mathx import nan_to_num

# The feature order of the reference's output rows (70 columns).
FEATURES = [
    "point_count", "backtrack_count",
    "x_first", "x_mean", "x_median", "x_std", "x_max", "x_min", "x_last",
    "y_first", "y_mean", "y_median", "y_std", "y_max", "y_min", "y_last",
    "t_first", "t_mean", "t_median", "t_std", "t_max", "t_min", "t_last",
    "time_delta_first", "time_delta_mean", "time_delta_median", "time_delta_std",
    "time_delta_max", "time_delta_min", "time_delta_last",
    "final_dis", "final_dx", "final_dy",
    "log_speed_mean", "log_speed_mean_dup", "log_speed_max", "log_speed_min",
    "log_accel_mean", "log_accel_median", "log_accel_max", "log_accel_min",
    "log_angle_mean", "log_angle_median", "log_angle_max", "log_angle_min",
    "aim_distance_first", "aim_distance_last", "aim_distance_mean",
    "aim_distance_median", "aim_distance_max", "aim_distance_min",
    "log_speed_diff_mean", "log_speed_diff_median", "log_speed_diff_max", "log_speed_diff_min",
    "log_accel_diff_mean", "log_accel_diff_median", "log_accel_diff_max", "log_accel_diff_min",
    "log_angle_diff_mean", "log_angle_diff_median", "log_angle_diff_max", "log_angle_diff_min",
    "aim_distance_diff_first", "aim_distance_diff_last", "aim_distance_diff_mean",
    "aim_distance_diff_median", "aim_distance_diff_max", "aim_distance_diff_min",
    "aim_angle",
]
# Columns 34-70 are passed through nan_to_num; 1-33 are emitted raw.
GUARDED_FROM = FEATURES.index("log_speed_mean")

# series name -> summary fields emitted (in FEATURES order)
_EMIT = [
    ("x", ["first", "mean", "median", "std", "max", "min", "last"]),
    ("y", ["first", "mean", "median", "std", "max", "min", "last"]),
    ("t", ["first", "mean", "median", "std", "max", "min", "last"]),
    ("time_delta", ["first", "mean", "median", "std", "max", "min", "last"]),
]


_COLUMN_CACHE: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _per_context(df: DataFrame, key, build):
    """Build a list of column expressions once per SparkContext.

    The expressions refer to columns by name only, so one set serves every
    DataFrame; re-creating thousands of JVM column objects per query costs
    seconds of driver time. The cache lives as long as the context does.
    """
    own = _COLUMN_CACHE.setdefault(df.sparkSession.sparkContext, {})
    if key not in own:
        own[key] = build()
    return own[key]


def _series_steps():
    return [
        [S.coords("points", "x").alias("xs"), S.coords("points", "y").alias("ys"),
         S.coords("points", "t").alias("ts")],
        [S.time_delta("ts").alias("time_delta"),
         S.log_speed_raw("xs", "ts").alias("_speed_raw"),
         S.log_angle_raw("xs", "ys").alias("_angle_raw"),
         S.aim_distance_compat("xs", "ys", "aim").alias("aim_distance")],
        [S.log_accel_raw("_speed_raw", "ts").alias("_accel_raw")],
        [S.pad_empty("_speed_raw").alias("log_speed"), S.pad_empty("_accel_raw").alias("log_accel"),
         S.pad_empty("_angle_raw").alias("log_angle")],
        [S.first_diff("log_speed").alias("log_speed_diff"),
         S.first_diff("log_accel").alias("log_accel_diff"),
         S.first_diff("log_angle").alias("log_angle_diff"),
         S.first_diff("aim_distance").alias("aim_distance_diff")],
    ]


def with_series(trajs: DataFrame) -> DataFrame:
    """Add the coordinate arrays and every derived series as columns.

    Built as successive projections so shared sub-expressions (dx, dt) are
    computed once per row.
    """
    df = trajs
    for step in _per_context(trajs, "series", _series_steps):
        df = df.select("*", *step)
    return df.drop("_speed_raw", "_accel_raw", "_angle_raw")


SERIES = ["x", "y", "t", "time_delta", "log_speed", "log_accel", "log_angle",
          "aim_distance", "log_speed_diff", "log_accel_diff", "log_angle_diff",
          "aim_distance_diff"]


def with_summaries(series_df: DataFrame, names=None) -> DataFrame:
    """Add ``<series>_stats`` structs (first,last,std,mean,median,max,min)."""
    names = tuple(names or SERIES)
    src = {"x": "xs", "y": "ys", "t": "ts"}
    cols = _per_context(series_df, ("summaries", names),
                        lambda: [A.summary(src.get(n, n)).alias(f"{n}_stats") for n in names])
    return series_df.select("*", *cols)


def _feature_columns():
    cols = [A.point_count("xs").alias("point_count"),
            A.backtrack_count("xs").alias("backtrack_count")]
    for name, fields in _EMIT:
        cols += [F.col(f"{name}_stats.{f}").alias(f"{name}_{f}") for f in fields]
    off = A.final_offset("xs", "ys", "aim")
    cols += [off["dis"].alias("final_dis"), off["dx"].alias("final_dx"),
             off["dy"].alias("final_dy")]
    g = []
    g += [F.col("log_speed_stats.mean"), F.col("log_speed_stats.mean"),
          F.col("log_speed_stats.max"), F.col("log_speed_stats.min")]
    for s in ("log_accel", "log_angle"):
        g += [F.col(f"{s}_stats.{f}") for f in ("mean", "median", "max", "min")]
    g += [F.col(f"aim_distance_stats.{f}") for f in ("first", "last", "mean", "median", "max", "min")]
    for s in ("log_speed_diff", "log_accel_diff", "log_angle_diff"):
        g += [F.col(f"{s}_stats.{f}") for f in ("mean", "median", "max", "min")]
    g += [F.col(f"aim_distance_diff_stats.{f}")
          for f in ("first", "last", "mean", "median", "max", "min")]
    g.append(A.aim_angle("xs", "ys", "aim"))
    return cols, g


def feature_matrix(trajs: DataFrame, labelled: bool = True, keep=("traj_id",),
                   with_speed_median: bool = False) -> DataFrame:
    """Parsed trajectories -> ``traj_id``, the 70 features in order, [label].

    ``with_speed_median`` appends ``log_speed_median`` (guarded), which the
    reference computes but never emits (it writes the mean twice); the ML
    table uses it in place of the duplicate.
    """
    df = with_summaries(with_series(trajs))

    def build():
        raw, guarded = _feature_columns()
        return raw + [nan_to_num(c).alias(n) for c, n in zip(guarded, FEATURES[GUARDED_FROM:])]
    cols = list(keep) + list(_per_context(df, "features", build))
    if with_speed_median:
        cols.append(nan_to_num(F.col("log_speed_stats.median")).alias("log_speed_median"))
    if labelled:
        cols.append(F.col("label"))
    return df.select(*cols)


def ml_feature_names(columns) -> list[str]:
    names = [c for c in FEATURES if c != "log_speed_mean_dup"]
    return names + (["log_speed_median"] if "log_speed_median" in columns else [])


def ml_table(features: DataFrame, label_col: str = "label", keep=()) -> DataFrame:
    """Features with a ``double`` label and a ``features`` vector for Spark ML.

    NaN becomes 0 and infinities the largest doubles in all columns: the trainer
    takes finite numbers only, and the reference writes NaN as 0 before training.
    The duplicate speed-mean column is left out; ``log_speed_median`` takes
    its place when present (see ``feature_matrix(with_speed_median=True)``).
    """
    from pyspark.ml.feature import VectorAssembler
    cols = ml_feature_names(features.columns)
    df = features.select("traj_id", *[nan_to_num(F.col(c).cast("double")).alias(c) for c in cols],
                         *([F.col(label_col).cast("double").alias("label")]
                           if label_col in features.columns else []), *keep)
    return VectorAssembler(inputCols=cols, outputCol="features",
                           handleInvalid="keep").transform(df)


def feature_text(features: DataFrame, labelled: bool = True, with_id: bool = False) -> DataFrame:
    """Space-joined text rows in the reference's output layout.

    NaN renders as ``0``; numbers use Spark's double rendering (see README).
    ``with_id`` puts ``traj_id`` before the numbers.
    """
    def txt(c):
        col = F.col(c)
        if c in ("point_count", "backtrack_count"):
            return col.cast("string")
        return F.when(F.isnan(col), F.lit("0")).otherwise(col.cast("string"))
    parts = ([F.col("traj_id").cast("string")] if with_id else []) + [txt(c) for c in FEATURES]
    return features.select(F.concat_ws(" ", *parts, *([F.col("label")] if labelled else [])).alias("value"))
