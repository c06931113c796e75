"""Tables bucketed and sorted by a key, so that tables of the same key meet without an exchange.

Predictions arrive again and again for the same trajectories. Both sides written
once with the same number of buckets are joined bucket by bucket: the rows move when
a table is written, not each time it is joined. Buckets hold about
``ROWS_PER_BUCKET`` rows, so their number grows with the table; two tables meet
without an exchange if they have the same number.

Ids are meant to be unique. Null ids are kept (they match nothing) and, like a
repeated id, lie in one bucket, which is written and read as a sorted stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.decide import SCORE_THRESHOLD, join_predictions

ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two with about ``rows_per_bucket`` rows in each bucket, so that tables of like size agree."""
    return 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, key: str = "traj_id", buckets: int | None = None,
                   path: str | None = None) -> int:
    """Write ``df`` as ``table``, one sorted file a bucket (outside the warehouse with ``path``); returns the buckets."""
    n = buckets or buckets_for(df.count())
    # the exchange deals rows as the buckets do, so a task writes whole buckets
    w = df.repartition(n, key).write.format("parquet").mode("overwrite").bucketBy(n, key).sortBy(key)
    (w.option("path", path) if path else w).saveAsTable(table)
    return n


def join_bucketed(spark: SparkSession, predictions: str, trajectories: str, key: str = "traj_id",
                  threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """``decide.join_predictions`` on two tables that :func:`write_bucketed` wrote with the same buckets."""
    return join_predictions(spark.table(predictions), spark.table(trajectories), key, threshold)
