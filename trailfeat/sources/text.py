"""Text sources of the reference's formats.

* trajectory lines (labelled / unlabelled), parsed with a quarantine;
* class predictions (one class literal per line);
* score predictions (tab-separated, score in column index 1).

The reference identifies prediction rows by their line number. A line here
carries the file, the offset of its split and an id that grows by one from line
to line within a split; :func:`line_numbers` turns these into line numbers with
one small aggregate (a row per split), without moving or sorting the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.parse import parse_trajectories, py_float

LINE_ORDER = ["_file", "_block", "_row"]


def read_lines(spark: SparkSession, path) -> DataFrame:
    """``value`` plus a file-order key (``_file, _block, _row``)."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))


def line_numbers(lines: DataFrame) -> DataFrame:
    """Replace the file-order key of ``read_lines`` by ``ordinal``, the 1-based line number over all files by name."""
    splits = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    w = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of the input
    starts = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    kept = [c for c in lines.columns if c not in LINE_ORDER]
    return lines.join(F.broadcast(starts), ["_file", "_block"]).select(
        *kept, (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("ordinal"))


def read_trajectories(spark: SparkSession, path, labelled: bool = True,
                      mode: str = "quarantine") -> DataFrame:
    """Trajectory text -> ``traj_id, points, aim, [label], reason``."""
    return parse_trajectories(spark.read.text(path), labelled=labelled, mode=mode)


def read_class_predictions(spark: SparkSession, path) -> DataFrame:
    """``label`` (the whole line) plus the file-order key."""
    return read_lines(spark, path).select(*LINE_ORDER, F.col("value").alias("label"))


def read_score_predictions(spark: SparkSession, path, mode: str = "strict") -> DataFrame:
    """``score`` (tab field 1, a number Python's float() would take), ``reason``, and the file-order key.

    ``reason`` is ``no_score`` for a line without a tab, ``bad_score`` for a field
    that is no number, else null. ``mode="strict"`` (default) fails on such a line,
    as the reference does; ``mode="quarantine"`` keeps it with a null score.
    """
    if mode not in ("quarantine", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    field = F.get(F.split("value", "\t", -1), 1)
    score = py_float(field)
    reason = F.when(field.isNull(), "no_score").when(score.isNull(), "bad_score")
    if mode == "strict":
        score = F.when(reason.isNotNull(), F.raise_error(F.concat(
            F.lit("bad prediction line: "), reason, F.lit(": "), F.col("value"))).cast("double")).otherwise(score)
    return read_lines(spark, path).select(*LINE_ORDER, "value", score.alias("score"), reason.alias("reason"))
