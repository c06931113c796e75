"""Step series of a stream of points: the previous rows are carried from batch to batch.

Within a micro-batch the lags come from the ordered scan of ``plans.sequence``, so a
trajectory with a third of the batch's rows is spread over many tasks, which state
held by key in one task could not do. Between batches a state table keeps one row
for each trajectory: its last point, the point before that, and its position. A batch
writes the state of the trajectories that it touched, every ``SNAPSHOT``-th batch that
of all, so a batch reads at most ``SNAPSHOT`` small tables.

Output, late points and state of a batch lie in folders named after it and are
overwritten when the batch is repeated after a failure, so each point counts once.

The result does not depend on how the points are cut into batches as long as a
trajectory's points arrive in the order of their batches. A point that is not after
the last one of its trajectory's earlier batches is *late*: it is written to
``late_dir`` and changes nothing. Equal orders within a batch fail the stream, as
they do in the batch scan. A point without an id or order goes to ``late_dir`` too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.longform import step_series
from ..plans.sequence import sequence

#: A batch with a number divisible by this writes the state of all trajectories.
SNAPSHOT = 10
COORDS = ("x", "y", "t")
LAGS = 2


def _folder(root: str, batch: int) -> str:
    return f"{root.rstrip('/')}/batch={batch}"


def _newest(states: DataFrame, key: str) -> DataFrame:
    """One row a trajectory from state tables of several batches."""
    rest = [c for c in states.columns if c != key]
    return states.groupBy(key).agg(F.max_by(F.struct(*rest), "_state_batch").alias("_s")).select(key, "_s.*")


def carried(spark: SparkSession, state_dir: str, batch: int, key: str) -> DataFrame | None:
    """The state before ``batch``: one row a trajectory, or None before the first."""
    if batch == 0:
        return None
    first = (batch - 1) // SNAPSHOT * SNAPSHOT
    parts = [spark.read.parquet(_folder(state_dir, b)) for b in range(first, batch)]
    states = parts[0]
    for p in parts[1:]:
        states = states.unionByName(p)
    return _newest(states, key)


def process(points: DataFrame, batch: int, output_dir: str, late_dir: str, state_dir: str, key: str = "traj_id",
            order=("ts", "event_id"), rows_per_block: int | None = None) -> None:
    """Write the step series, the late points and the state of one micro-batch."""
    spark, order = points.sparkSession, list(order)
    state = carried(spark, state_dir, batch, key)
    names = [f"_{c}{j}" for j in (1, 2) for c in COORDS]
    whole = F.col(key).isNotNull()
    for c in order:
        whole = whole & F.col(c).isNotNull()
    if state is None:
        rows = points.select("*", F.lit(None).cast("long").alias("_seen"),
                             *[F.lit(None).cast("double").alias(c) for c in names])
        late = ~whole
    else:
        rows = points.join(state.drop("_state_batch"), key, "left")
        after = F.struct(*order) > F.struct(*[F.col(f"_at{i}") for i in range(len(order))])
        late = ~whole | (F.col("_seen").isNotNull() & ~F.coalesce(after, F.lit(False)))
    rows.where(late).select(*points.columns).write.mode("overwrite").parquet(_folder(late_dir, batch))

    fresh = rows.where(~late).select(*points.columns, "_seen", *names)
    lagged = sequence(fresh, [key], order, lag_cols=list(COORDS), lags=LAGS, pos_col="_here", rows_per_block=rows_per_block)
    here = F.col("_here")
    cols = []
    for c in COORDS:
        cols += [F.when(here == 0, F.col(f"_{c}1")).otherwise(F.col(f"{c}_lag1")).alias(f"{c}_lag1"),
                 F.when(here == 0, F.col(f"_{c}2")).when(here == 1, F.col(f"_{c}1")).otherwise(F.col(f"{c}_lag2")).alias(f"{c}_lag2")]
    out = lagged.select(*points.columns, (here + F.coalesce("_seen", F.lit(0))).cast("long").alias("pos"), *cols)
    step_series(out).write.mode("overwrite").parquet(_folder(output_dir, batch))

    # the last row of a trajectory holds its predecessor too; combined before the shuffle
    written = spark.read.parquet(_folder(output_dir, batch))
    last = F.max_by(F.struct(F.expr("pos + 1").alias("_seen"), *[F.col(c).alias(f"_at{i}") for i, c in enumerate(order)],
                             *[F.col(c).alias(f"_{c}1") for c in COORDS], *[F.col(f"{c}_lag1").alias(f"_{c}2") for c in COORDS]), "pos")
    new = written.groupBy(key).agg(last.alias("_s")).select(key, F.lit(batch).cast("long").alias("_state_batch"), "_s.*")
    if batch % SNAPSHOT == 0 and state is not None:
        new = _newest(state.unionByName(new), key)
    new.write.mode("overwrite").parquet(_folder(state_dir, batch))


def start_step_stream(spark: SparkSession, input_dir: str, schema: T.StructType | str, output_dir: str, late_dir: str,
                      checkpoint_location: str, key: str = "traj_id", order=("ts", "event_id"), available_now: bool = False,
                      max_files_per_trigger: int | None = None, rows_per_block: int | None = None) -> StreamingQuery:
    """Follow Parquet files of points ``(key, order..., x, y, t)`` as they arrive in ``input_dir``."""
    if not checkpoint_location:
        raise ValueError("a lasting checkpoint_location is required")
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    root = checkpoint_location.rstrip("/")

    def each(points: DataFrame, batch: int) -> None:
        process(points, batch, output_dir, late_dir, f"{root}/state", key, order, rows_per_block)

    w = reader.parquet(input_dir).writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/offsets")
    return (w.trigger(availableNow=True) if available_now else w).start()
