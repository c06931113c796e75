"""End-to-end jobs equivalent to the reference's three entry points.

* :func:`features_job` - trajectory text -> 70 features (+ label), one pass;
* :func:`point_features_job` - the same from a table of points;
* :func:`train_job` - feature table -> boosted trees, predictions, weights;
* :func:`submission_job` - predictions -> ids (or line numbers) judged machine-made.

Bad records are never dropped silently: they are written to a quarantine beside
the output, or fail the job in strict mode.
"""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import longform as LF
from ..operators.decide import MACHINE_CLASS, SCORE_THRESHOLD
from ..operators.features import feature_matrix
from ..operators.parse import good
from ..sources import sinks
from ..sources.text import line_numbers, read_class_predictions, read_score_predictions, read_trajectories


def quarantine_beside(path: str) -> str:
    return path.rstrip("/") + "_quarantine"


def features_job(spark: SparkSession, input_path, output_path: str, labelled: bool = True,
                 mode: str = "quarantine", text_output: bool = False,
                 quarantine_path: str | None = None, with_speed_median: bool = True,
                 sink_mode: str = "overwrite") -> dict:
    """Parse, featurize and write in one pass over the input.

    Returns the counts observed during that pass: ``lines``, ``quarantined``
    and ``trajectories``. The bad records, if there are any, are written (a
    second, filter-only pass) to ``quarantine_path`` or ``<output>_quarantine``.
    ``with_speed_median`` adds ``log_speed_median`` to the parquet output;
    ``sink_mode="publish"`` replaces the former output all at once, or not at all.
    """
    parsed = read_trajectories(spark, input_path, labelled=labelled, mode=mode)
    obs = Observation("features")
    seen = parsed.observe(obs, F.count(F.lit(1)).alias("lines"),
                          F.count("reason").alias("quarantined"))
    fm = feature_matrix(good(seen), labelled=labelled, with_speed_median=with_speed_median and not text_output)
    if text_output:
        sinks.write_feature_text(fm, output_path, labelled, mode=sink_mode)
    else:
        sinks.write_features(fm, output_path, mode=sink_mode)
    out = dict(obs.get)
    out["trajectories"] = out["lines"] - out["quarantined"]
    if out["quarantined"] or quarantine_path:
        sinks.write_quarantine(parsed, quarantine_path or quarantine_beside(output_path))
    return out


def point_features_job(spark: SparkSession, input_path, output_path: str,
                       key: str = "traj_id", order=("pos",), labelled: bool = True, mode: str = "quarantine",
                       quarantine_path: str | None = None, rows_per_block: int = LF.ROWS_PER_BLOCK) -> dict:
    """Point table (parquet: ``key``, order columns, ``x, y, t, ax, ay``
    [, ``label``]) -> the 70 features per trajectory, skew-safe for
    trajectories of any length (see ``operators.longform``).

    ``order`` must be unique within a trajectory; equal orders fail the job.
    Points without an id, and trajectories with a null coordinate or target or with
    constants that vary between their points, are written to the quarantine
    (``traj_id, reason``), or fail the job in strict mode. Returns the counts
    ``trajectories`` and ``quarantined``.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    pts = spark.read.parquet(input_path)
    if key != "traj_id":
        pts = pts.withColumnRenamed(key, "traj_id")
    if not labelled and "label" not in pts.columns:
        pts = pts.withColumn("label", F.lit(None).cast("string"))
    named = pts.where("traj_id is not null")
    heavy = LF.heavy_keys(named, "traj_id", min(rows_per_block, LF.MEDIAN_POINTS))

    def steps(points):
        return LF.step_series(LF.lag_points(points, order=tuple(order), rows_per_block=rows_per_block))

    long = None if heavy is None else steps(named.join(heavy, "traj_id", "left_semi"))
    fm = LF.feature_matrix_long(steps(named), labelled=labelled, heavy=heavy, heavy_steps=long, with_speed_median=True,
                                with_reason=mode == "quarantine")
    nameless = pts.where("traj_id is null").select("traj_id", F.lit("no_id").alias("reason"))
    if mode == "strict":
        if not nameless.isEmpty():
            raise ValueError("points without an id")
        sinks.write_features(fm, output_path)
        return {"trajectories": spark.read.parquet(output_path).count(), "quarantined": 0}
    obs = Observation("features")
    seen = fm.observe(obs, F.count(F.lit(1)).alias("seen"), F.count("reason").alias("quarantined"))
    sinks.write_features(seen.where("reason is null").drop("reason"), output_path)
    out = dict(obs.get)
    lost = out["quarantined"] + nameless.count()
    if lost or quarantine_path:
        bad = fm.select("traj_id", "reason").where("reason is not null").unionByName(nameless)
        sinks.write_quarantine(bad, quarantine_path or quarantine_beside(output_path))
    return {"trajectories": out["seen"] - out["quarantined"], "quarantined": lost}


def submission_job(spark: SparkSession, input_path, output_path: str, kind: str = "score",
                   threshold: float = SCORE_THRESHOLD, mode: str = "strict",
                   quarantine_path: str | None = None, sink_mode: str = "overwrite") -> None:
    """Ids judged machine-made, one per line, ascending.

    ``kind="table"``: the parquet that :func:`train_job` writes; the ids are its
    ``traj_id``, flagged when score < threshold. ``kind="score"``: tab-separated
    text, flagged likewise; ``kind="class"``: class literals, flagged when the line is
    ``0.0``. The ids of text lines are their 1-based numbers. A bad score line fails
    the job, or is written to the quarantine with its number. ``sink_mode="publish"``
    replaces the former submission all at once, or not at all.
    """
    if kind == "table":
        ids = spark.read.parquet(input_path).where(F.col("score") < F.lit(threshold))
        sinks.write_submission(ids, output_path, "traj_id", mode=sink_mode)
        return
    if kind == "score":
        preds = line_numbers(read_score_predictions(spark, input_path, mode))
        flag = F.col("score") < F.lit(threshold)
    elif kind == "class":
        preds = line_numbers(read_class_predictions(spark, input_path))
        flag = F.col("label") == F.lit(MACHINE_CLASS)
    else:
        raise ValueError(kind)
    sinks.write_submission(preds.where(flag), output_path, mode=sink_mode)
    if kind == "score" and mode == "quarantine":
        bad = preds.where("reason is not null")
        if quarantine_path or not bad.isEmpty():
            sinks.write_quarantine(bad, quarantine_path or quarantine_beside(output_path),
                                   columns=("ordinal", "value", "reason"))


def train_job(spark: SparkSession, train_features_path: str, score_features_path: str,
              output_path: str, model_path: str | None = None, **model_args) -> dict:
    """Fit on labelled features, score the unlabelled ones, write predictions
    (and the model, its trees and feature weights when ``model_path`` is set).

    Returns the configured evaluation metrics on the training set
    (``logloss``, ``auc``), computed as distributed aggregates.
    """
    from ..operators import model as M
    from ..operators.evaluate import auc, logloss
    train = spark.read.parquet(train_features_path)
    score = spark.read.parquet(score_features_path)
    mdl = M.fit(train, **model_args)
    M.predict(mdl, score).write.mode("overwrite").parquet(output_path)
    if model_path:
        M.dump(mdl, model_path)
        M.feature_importance(train, model=mdl).write.mode("overwrite").parquet(
            model_path.rstrip("/") + "_feature_weights")
    fitted = M.predict(mdl, train, keep=("label",)).withColumn("truth", F.col("label").cast("double"))
    return {"logloss": logloss(fitted, "score", "truth").first()["logloss"],
            "auc": auc(fitted, "score", "truth").first()["auc"]}
