"""Summaries from a growing state equal those of all points at once."""
import tempfile

import numpy as np
import pytest

from trailfeat.operators import incremental as INC
from trailfeat.operators import longform as LF

SCHEMA = "traj_id string, ts long, x double, y double, t double"


def points(n=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = [("hot", 3 * i, float(v), float(rng.normal()), float(rng.integers(0, 5))) for i, v in enumerate(rng.normal(size=n).cumsum())]
    rows += [("one", 5, 1.0, 2.0, 3.0), ("two", 1, 1.0, 2.0, 3.0), ("two", 900, 0.5, 2.0, 9.0), ("late", 850, 4.0, 4.0, 4.0),
             ("early", 2, 7.0, 8.0, 9.0), ("early", 4, 7.5, 8.0, 9.5)]
    rows += [("nan", k, float("nan") if k == 40 else float(k), 1.0, float(k)) for k in range(0, 1200, 20)]
    return rows


def state_of(spark, rows, cuts):
    state = None
    for low, high in zip([-1, *cuts], [*cuts, 1 << 40]):
        part = [r for r in rows if low <= r[1] < high]
        path = tempfile.mkdtemp(prefix="trailfeat-state-")
        INC.updated(state, spark.createDataFrame(part, SCHEMA).coalesce(2), order=("ts",)).write(path)
        state = INC.read_state(spark, path)
    return state


def rows_of(state):
    return {(r.traj_id, r.series): r for r in INC.summaries(state).collect()}


@pytest.mark.parametrize("cuts", [[6, 300, 851]])
def test_any_cut_gives_the_whole(spark, cuts):
    rows = points()
    whole = rows_of(state_of(spark, rows, []))
    parts = rows_of(state_of(spark, rows, cuts))
    assert whole.keys() == parts.keys()
    for k, a in whole.items():
        b = parts[k]
        assert (a.n, a.first, a.last) == pytest.approx((b.n, b.first, b.last), nan_ok=True)
        assert (a["mean"], a["std"], a["max"], a["min"]) == pytest.approx((b["mean"], b["std"], b["max"], b["min"]), nan_ok=True, abs=1e-9)


def test_state_equals_the_summaries_of_all_points(spark):
    rows = [r for r in points() if r[0] in ("hot", "two", "early")]
    df = spark.createDataFrame(rows, SCHEMA)
    state = state_of(spark, rows, [100, 500])
    want = {r.traj_id: r for r in LF.trajectory_summaries(LF.step_series(LF.lag_points(df, order=("ts",)))).collect()}
    got = rows_of(state)
    for (key, series), r in got.items():
        for stat in ("first", "last", "mean", "std", "max", "min"):
            assert r[stat] == pytest.approx(want[key][f"{series}_{stat}"], abs=1e-9, nan_ok=True), (key, series, stat)
    counts = {r.traj_id: (r.points, r.backtracks) for r in state.points.collect()}
    assert counts == {k: (w.point_count, w.backtrack_count) for k, w in want.items()}


def test_sketch_keeps_its_rank_error(spark):
    rows = [("k", i, float((i * 7919) % 20_011), 0.0, 0.0) for i in range(20_000)]
    got = rows_of(state_of(spark, rows, [5000]))["k", "x"]
    xs = np.sort([r[2] for r in rows])
    assert abs(np.searchsorted(xs, got["median"]) / len(xs) - 0.5) <= 1.5 * INC.sketch_error()


def test_late_points_are_refused(spark):
    state = state_of(spark, [("a", 10, 1.0, 1.0, 1.0)], [])
    with pytest.raises(Exception, match="late"):
        INC.updated(state, spark.createDataFrame([("a", 9, 1.0, 1.0, 1.0)], SCHEMA), order=("ts",)).points.collect()


def test_empty_parts(spark):
    rows = [("a", 1, 1.0, 2.0, 3.0), ("a", 2, 2.0, 2.0, 4.0)]
    state = state_of(spark, rows, [])
    none = INC.updated(state, spark.createDataFrame([], SCHEMA), order=("ts",))
    assert rows_of(none) == rows_of(state)
    assert INC.summaries(INC.updated(None, spark.createDataFrame([], SCHEMA), order=("ts",))).collect() == []
