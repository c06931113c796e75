"""Structured Streaming form of the feature job.

Each trajectory line is independent, so the batch plan runs unchanged on a
stream of new text files: no state, no watermark, append mode. Bad records go
to a second stream into the quarantine. Each stream needs a checkpoint location
of its own that lasts from one start to the next, so that a restart goes on
where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.features import feature_matrix
from ..operators.parse import good, parse_trajectories, quarantined


def _lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir)


def start_feature_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                         quarantine_dir: str, labelled: bool = True, available_now: bool = False,
                         max_files_per_trigger: int | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both streams: features into ``output_dir``, bad records (``traj_id, reason``) into ``quarantine_dir``."""
    if not checkpoint_location:
        raise ValueError("a lasting checkpoint_location is required")
    parsed = parse_trajectories(_lines(spark, input_dir, max_files_per_trigger), labelled=labelled)
    started = []
    for name, df, path in (("features", feature_matrix(good(parsed), labelled=labelled), output_dir),
                           ("quarantine", quarantined(parsed).select("traj_id", "reason"), quarantine_dir)):
        w = (df.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", f"{checkpoint_location.rstrip('/')}/{name}"))
        started.append((w.trigger(availableNow=True) if available_now else w).start())
    return started[0], started[1]
