"""Step series of a stream: equal to the batch scan in any batch split; late points change nothing."""

import os
import random
import tempfile

import pytest

from trailfeat.operators.longform import lag_points, step_series
from trailfeat.streaming import step_stream
from trailfeat.streaming.step_stream import process, start_step_stream

SCHEMA = "traj_id string, ts long, event_id long, x double, y double, t double"
COLS = ["traj_id", "event_id", "pos", "dx", "dy", "time_delta", "log_speed", "log_accel_diff"]


def points(seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice("aaabcd"), i // 2, i, float(rng.randrange(50)), float(rng.randrange(50)), float(i * rng.randrange(1, 4))) for i in range(n)]


def batch_result(spark, rows):
    df = step_series(lag_points(spark.createDataFrame(rows, SCHEMA), order=("ts", "event_id")))
    return sorted(map(repr, df.select(*COLS).collect()))


def run(spark, splits):
    root = tempfile.mkdtemp(prefix="trailfeat-steps-")
    dirs = [os.path.join(root, d) for d in ("out", "late", "state")]
    for b, rows in enumerate(splits):
        process(spark.createDataFrame(rows, SCHEMA), b, *dirs)
    return dirs


def result(spark, out):
    return sorted(map(repr, spark.read.parquet(out).select(*COLS).collect()))


@pytest.mark.parametrize("cuts", [[1], [10, 11, 40], [20, 20, 59]])
def test_any_split_equals_the_batch_scan(spark, cuts):
    rows = points(len(cuts))
    edges = [0, *cuts, len(rows)]
    out, late, _ = run(spark, [rows[a:b] for a, b in zip(edges, edges[1:])])
    assert result(spark, out) == batch_result(spark, rows)
    assert spark.read.parquet(late).count() == 0


def test_snapshots_keep_all_trajectories(spark, monkeypatch):
    monkeypatch.setattr(step_stream, "SNAPSHOT", 2)
    rows = [("once", 0, -1, 1.0, 2.0, 0.0), *points(7, 24), ("once", 99, 99, 4.0, 6.0, 9.0)]
    rows[1:-1] = [(k, ts + 1, e, x, y, t) for k, ts, e, x, y, t in rows[1:-1]]
    out, _, state = run(spark, [rows[:1], *[rows[i:i + 5] for i in range(1, 25, 5)], rows[25:]])
    assert result(spark, out) == batch_result(spark, rows)
    assert spark.read.parquet(os.path.join(state, "batch=4")).where("traj_id = 'once'").count() == 1


def test_late_points_and_points_without_id(spark):
    rows = points(3, 20)
    late = [rows[4], ("a", -5, 999, 0.0, 0.0, 0.0), (None, 50, 1000, 0.0, 0.0, 0.0), ("a", None, 1001, 0.0, 0.0, 0.0)]
    late[0] = next(r for r in rows[:10] if r[0] == "a")
    out, at, _ = run(spark, [rows[:10], rows[10:] + late])
    assert result(spark, out) == batch_result(spark, rows)
    assert sorted(r.event_id for r in spark.read.parquet(at).collect()) == sorted(r[2] for r in late)


def test_repeated_batch_counts_once(spark):
    rows = points(5, 30)
    out, late, state = run(spark, [rows[:10], rows[10:20]])
    for _ in range(2):
        process(spark.createDataFrame(rows[10:20], SCHEMA), 1, out, late, state)
    process(spark.createDataFrame(rows[20:], SCHEMA), 2, out, late, state)
    assert result(spark, out) == batch_result(spark, rows) and spark.read.parquet(late).count() == 0


def test_equal_orders_in_a_batch_are_refused(spark):
    with pytest.raises(Exception, match="order is undefined"):
        run(spark, [[("a", 1, 1, 0.0, 0.0, 0.0)] * 2])


def test_hot_trajectory_is_cut_into_blocks(spark):
    rows = [("hot", i, i, float(i % 7), float(i % 5), float(i)) for i in range(300)]
    root = tempfile.mkdtemp(prefix="trailfeat-steps-")
    dirs = [os.path.join(root, d) for d in ("out", "late", "state")]
    for b in range(3):
        process(spark.createDataFrame(rows[b * 100:(b + 1) * 100], SCHEMA), b, *dirs, rows_per_block=16)
    assert result(spark, dirs[0]) == batch_result(spark, rows)


def test_stream_restarts(spark):
    rows, root = points(11, 40), tempfile.mkdtemp(prefix="trailfeat-steps-")
    d = {n: os.path.join(root, n) for n in ("in", "out", "late", "ckpt")}
    for part in (rows[:13], rows[13:14], [], rows[14:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(d["in"])
        start_step_stream(spark, d["in"], SCHEMA, d["out"], d["late"], d["ckpt"], available_now=True).awaitTermination()
    assert result(spark, d["out"]) == batch_result(spark, rows)
    with pytest.raises(ValueError):
        start_step_stream(spark, d["in"], SCHEMA, d["out"], d["late"], "")
