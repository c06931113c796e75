"""Sinks: feature tables, the compatible feature text, submissions, quarantine.

With ``mode="publish"`` an output changes all at once (see ``sources.publish``) and is
read with ``read_published``; ``overwrite`` deletes the former output first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import feature_text
from .publish import publish


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    if mode == "publish":
        publish(df, path, fmt)
    else:
        df.write.mode(mode).format(fmt).save(path)


def write_features(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Primary sink: named double columns as parquet."""
    _write(features, path, "parquet", mode)


def write_feature_text(features: DataFrame, path: str, labelled: bool = True,
                       mode: str = "overwrite", with_id: bool = False) -> None:
    """Compatible sink: one space-joined line per trajectory (NaN -> ``0``)."""
    _write(feature_text(features, labelled, with_id), path, "text", mode)


def write_submission(ids: DataFrame, path: str, col: str = "ordinal",
                     mode: str = "overwrite") -> None:
    """One id per line, ascending over the files in name order (a range sort)."""
    _write(ids.select(col).orderBy(col).select(F.col(col).cast("string").alias("value")), path, "text", mode)


def write_quarantine(bad: DataFrame, path: str, mode: str = "overwrite", columns=("traj_id", "reason")) -> None:
    """Bad records with their reason, as parquet."""
    bad.filter(F.col("reason").isNotNull()).select(*columns).write.mode(mode).parquet(path)
