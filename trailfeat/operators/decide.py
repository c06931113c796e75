"""Decisions on predictions: which trajectories are flagged as machine-made.

The reference pulls every prediction to the driver and loops over it; here
each step stays a distributed DataFrame operation keyed by ``traj_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sequence import global_rank

# Fixed values from the reference's decision scripts.
MACHINE_CLASS = "0.0"      # class output: the literal text flagged as machine
SCORE_THRESHOLD = 0.97     # probability output: flagged when score < threshold


def by_class(preds: DataFrame, label_col: str = "label", cls: str = MACHINE_CLASS) -> DataFrame:
    """Rows whose class text is exactly ``cls``."""
    return preds.filter(F.col(label_col) == F.lit(cls))


def by_score(preds: DataFrame, score_col: str = "score",
             threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Rows with ``score < threshold`` (strict)."""
    return preds.filter(F.col(score_col) < F.lit(threshold))


def flagged_count(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count(F.lit(1)).alias("flagged"))


def preview(df: DataFrame, k: int = 10, order=("traj_id",)) -> DataFrame:
    """Deterministic first ``k`` rows: a top-k per partition, then merged; ``k`` is the feature."""
    return df.orderBy(*order).limit(k)


def submission_ordinals(preds: DataFrame, order=("traj_id",), flag: Column | None = None) -> DataFrame:
    """1-based row numbers (in ``order``) of the flagged predictions.

    The reference numbers lines in file order; with an explicit key the
    numbering is the rank in ``order``, computed with the blocked global rank
    (no single-partition window, nothing collected).
    """
    flag = (F.col("label") == F.lit(MACHINE_CLASS)) if flag is None else flag
    r = global_rank(preds.select(*order, flag.alias("_flag")), list(order))
    return r.filter("_flag").select((F.col("pos") + 1).alias("ordinal"))


def user_scores(events: DataFrame) -> DataFrame:
    """Per-trajectory score fixture: min(1, mean cents per event // 1 / 10000).

    Computed on integer cents (exact in any engine and any summation order),
    so the score never depends on how a rounding tie falls.
    """
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    mean_cents = F.floor(cents / F.count(F.lit(1)))
    return events.groupBy(F.col("user_id").alias("traj_id")).agg(
        F.least(F.lit(1.0), mean_cents / 10000.0).alias("score"))


def join_predictions(preds: DataFrame, trajs: DataFrame, key: str = "traj_id",
                     threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Align predictions with trajectories by key (the reference relies on line order).

    An outer join: ``matched`` is ``both``, ``prediction`` or ``trajectory``, so rows
    that only one side has are reported, not lost. ``flagged`` is null without a score.
    """
    p = preds.withColumn("_p", F.lit(True))
    t = trajs.withColumn("_t", F.lit(True))
    matched = F.when(F.col("_p") & F.col("_t"), "both").when(F.col("_p"), "prediction").otherwise("trajectory")
    return p.join(t, key, "full_outer").select("*", (F.col("score") < F.lit(threshold)).alias("flagged"),
                                               matched.alias("matched")).drop("_p", "_t")
