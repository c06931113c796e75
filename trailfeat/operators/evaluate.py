"""Evaluation metrics the model stage is configured with (AUC, log loss) and
the positive-class weighting, as distributed aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sequence import sequence

# Fixed value from the boosted-tree configuration.
POS_WEIGHT = 10.0
LOGLOSS_EPS = 1e-15


def class_weights(df: DataFrame, label: str = "label", pos_weight: float = POS_WEIGHT) -> DataFrame:
    """Adds ``weight``: ``pos_weight`` for label 1, else 1."""
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(pos_weight)).otherwise(F.lit(1.0)))


def score_counts(df: DataFrame, score: str = "score", label: str = "label", by=()) -> DataFrame:
    """One row per distinct score (of each group ``by``): ``_s, _pos`` (rows with label 1), ``_cnt``."""
    return df.groupBy(*by, F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("_pos"), F.count(F.lit(1)).alias("_cnt"))


def auc_of_counts(counts: DataFrame, by=()) -> DataFrame:
    """Exact ROC AUC (of each group ``by``) by the rank-sum statistic from ``score_counts``, ties getting their mean rank.

    The cumulative count below each score comes from the blocked ordered scan.
    Twice the rank sum is added up in 38-digit decimals (exact), and only the last
    quotient is a double. NULL when either class is missing.
    """
    keys = list(by) or ["_all"]
    r = sequence(counts if by else counts.withColumn("_all", F.lit(0)), keys, ["_s"], sum_cols=["_cnt"])
    wide = lambda c: c.cast("decimal(19,0)")
    twice_mean_rank = 2 * F.col("_cnt_cum") - F.col("_cnt") + 1
    tot = r.groupBy(*by).agg(F.sum((wide(F.col("_pos")) * wide(twice_mean_rank)).cast("decimal(38,0)")).alias("rs"),
                             F.sum("_pos").alias("p"), F.sum("_cnt").alias("n"))
    p, n = F.col("p"), F.col("n") - F.col("p")
    over = F.col("rs") - (wide(p) * wide(p + 1)).cast("decimal(38,0)")
    return tot.select(*by, F.when((p > 0) & (n > 0), over.cast("double") / (2.0 * p.cast("double") * n.cast("double"))).alias("auc"))


def auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact ROC AUC over the rows of ``df`` (see :func:`auc_of_counts`)."""
    return auc_of_counts(score_counts(df, score, label))


def logloss(df: DataFrame, score: str = "score", label: str = "label",
            eps: float = LOGLOSS_EPS) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1.0 - y) * F.log(1.0 - p))).alias("logloss"))


#: Bins of a score histogram.
SCORE_BINS = 1000


def score_histogram(df: DataFrame, score: str = "score", label: str = "label", bins: int = SCORE_BINS) -> DataFrame:
    """``(bin, n, pos)``: rows and positive rows with a score in ``[bin / bins, (bin + 1) / bins)``; scores are in [0, 1].

    One pass, at most ``bins`` rows from each task, and histograms of parts of the data add up.
    """
    at = F.least(F.greatest(F.floor(F.col(score) * F.lit(bins)), F.lit(0)), F.lit(bins - 1)).cast("long")
    return df.where(F.col(score).isNotNull()).groupBy(at.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"))


def threshold_curve(histogram: DataFrame, bins: int = SCORE_BINS) -> DataFrame:
    """What flagging every score below a threshold does, for the upper edge of each bin that occurs.

    ``(threshold, flagged, flagged_share, tpr, fpr, precision)``; a flagged row is right when its label is not 1
    (machine-made), so ``tpr`` is the share of those that are flagged and ``fpr`` the share of the others. The
    histogram has a bounded number of rows, so the running sums need no spread. Rates at a bin's edge are exact; between
    two edges they lie between theirs, so a wanted share is met within the share of one bin.
    """
    below = "over (order by bin)"
    run = histogram.selectExpr("bin", f"sum(n) {below} as flagged", f"sum(pos) {below} as human",
                               "sum(n) over () as total", "sum(pos) over () as humans")
    machines = "nullif(total - humans, 0)"
    return run.selectExpr(f"(bin + 1) / {bins}.0D as threshold", "flagged", "flagged / total as flagged_share",
                          f"(flagged - human) / {machines} as tpr", "human / nullif(humans, 0) as fpr",
                          "(flagged - human) / flagged as precision")


def threshold_for_share(curve: DataFrame, share: float) -> DataFrame:
    """The largest threshold of a curve that flags at most ``share`` of the rows (0.0 where even the first flags more)."""
    return curve.where(F.col("flagged_share") <= F.lit(share)).agg(F.coalesce(F.max("threshold"), F.lit(0.0)).alias("threshold"))
