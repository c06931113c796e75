"""Summaries that grow day by day: a stored, mergeable state for each trajectory.

A state has one row for each trajectory and series with the count, mean and second
moment (merged by Chan's formulas), minimum, maximum, a NaN flag, the first and last
value, and a KLL sketch for quantiles, and one for each trajectory with its points,
backtracks and last point. ``updated`` reads the state and the new points
alone: the last point of the state gives the step across the border. The new state equals
that of all points read at once, however they are cut into days (means and deviations
up to rounding); medians come from the sketch, whose rank error ``sketch_error`` states.

New points must come after the state's points of the same trajectory in ``order``
(a trajectory whose points come late is refused with an error).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .longform import STEP_SERIES, lag_points, step_series

SERIES = ["x", "y", "t", *STEP_SERIES]
#: Size parameter of the sketches.
SKETCH_K = 200


def sketch_error(k: int = SKETCH_K) -> float:
    """Rank error that a sketch keeps with 99 % confidence, as a share of its values (a fixed property of KLL)."""
    return 2.296 / k ** 0.9021


@dataclass
class State:
    """Two tables: ``points``, one row per trajectory, and ``series``, one row per trajectory and series."""

    points: DataFrame
    series: DataFrame

    def write(self, path: str) -> None:
        self.points.write.parquet(f"{path}/points")
        self.series.write.parquet(f"{path}/series")


def read_state(spark: SparkSession, path: str) -> State:
    return State(spark.read.parquet(f"{path}/points"), spark.read.parquet(f"{path}/series"))


def _partial(steps: DataFrame, key: str, order: list[str]) -> State:
    """The state of the steps of one batch."""
    names = ", ".join(f"`{c}`" for c in order)
    points = steps.groupBy(key).agg(*[F.expr(e) for e in (
        "count(1) AS points", "CAST(sum(CASE WHEN dx < 0 THEN 1 ELSE 0 END) AS BIGINT) AS backtracks",
        f"min(struct({names})) AS first_at", f"max(struct({names})) AS last_at",
        f"max(struct({names}, x, y, t)) AS last_point")])
    stacked = steps.selectExpr(key, f"struct({names}) AS _at", "inline(array(" + ", ".join(
        f"named_struct('series', '{v}', 'v', CAST({v} AS DOUBLE))" for v in SERIES) + "))").where("v is not null")
    plain = "CASE WHEN NOT isnan(v) THEN v END"
    series = stacked.groupBy(key, "series").agg(*[F.expr(e) for e in (
        f"count({plain}) AS n", f"avg({plain}) AS mean", f"var_pop({plain}) * count({plain}) AS m2", f"min({plain}) AS min",
        f"max({plain}) AS max", "max(isnan(v)) AS nan", "min_by(v, _at) AS first", "max_by(v, _at) AS last",
        f"kll_sketch_agg_double({plain}, {SKETCH_K}) AS sketch")])
    return State(points, series)


def _joined(old: DataFrame, new: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Rows of both tables; where both have one, the columns are as given (``a`` is the earlier, ``b`` the later part)."""
    both = old.alias("a").join(new.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    only_a, only_b = f"b.{keys[0]} IS NULL", f"a.{keys[0]} IS NULL"
    return both.selectExpr(*[f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys], *[
        f"CASE WHEN {only_b} THEN b.`{c}` WHEN {only_a} THEN a.`{c}` ELSE {e} END AS `{c}`" for c, e in columns.items()])


def merged(old: State, new: State, key: str = "traj_id") -> State:
    """The state of two parts; ``new`` holds the later points."""
    late = f"CAST(raise_error(concat('points come late: ', CAST(b.{key} AS STRING))) AS BIGINT)"
    points = _joined(old.points, new.points, [key], {
        "points": f"CASE WHEN b.first_at <= a.last_at THEN {late} ELSE a.points + b.points END",
        "backtracks": "a.backtracks + b.backtracks", "first_at": "a.first_at", "last_at": "b.last_at", "last_point": "b.last_point"})
    share = "(b.mean - a.mean)"
    series = _joined(old.series, new.series, [key, "series"], {
        "n": "a.n + b.n",
        "mean": f"CASE WHEN a.n = 0 THEN b.mean WHEN b.n = 0 THEN a.mean ELSE a.mean + {share} * b.n / (a.n + b.n) END",
        "m2": f"CASE WHEN a.n = 0 THEN b.m2 WHEN b.n = 0 THEN a.m2 ELSE a.m2 + b.m2 + {share} * {share} * a.n * b.n / (a.n + b.n) END",
        "min": "least(a.min, b.min)", "max": "greatest(a.max, b.max)", "nan": "a.nan OR b.nan", "first": "a.first", "last": "b.last",
        "sketch": "coalesce(kll_sketch_merge_double(a.sketch, b.sketch), a.sketch, b.sketch)"})
    return State(points, series)


def updated(state: State | None, points: DataFrame, key: str = "traj_id", order=("pos",)) -> State:
    """The state after the new ``points (key, order..., x, y, t)``, ids not null; ``state`` is None at first."""
    order = list(order)
    rows = points.select(key, *order, *[F.col(c).cast("double").alias(c) for c in "xyt"], F.lit(False).alias("_old"))
    if state is not None:
        last = state.points.select(key, *[F.col(f"last_point.{c}").alias(c) for c in [*order, *"xyt"]], F.lit(True).alias("_old"))
        rows = rows.unionByName(last.join(points.select(key).distinct(), key, "left_semi"))
    renamed = {"pos": "_order_pos"} if "pos" in order else {}
    lagged = lag_points(rows.withColumnsRenamed(renamed), key, [renamed.get(c, c) for c in order], lags=1)
    # a new point's step reaches back to the last point of the state
    steps = step_series(lagged).where("not _old").drop("pos").withColumnsRenamed({v: k for k, v in renamed.items()})
    new = _partial(steps, key, order)
    return new if state is None else merged(state, new, key)


def summaries(state: State, key: str = "traj_id") -> DataFrame:
    """``(key, series, n, first, last, mean, std, max, min, median)``; a NaN makes all but first and last NaN.

    ``median`` is the sketch's: a value whose rank is off by ``sketch_error`` of the values at most.
    """
    return state.series.selectExpr(key, "series", "n", "first", "last", *[
        f"CASE WHEN nan THEN double('NaN') ELSE {e} END AS {c}" for c, e in (
            ("mean", "mean"), ("std", "sqrt(m2 / n)"), ("max", "max"), ("min", "min"),
            ("median", "CASE WHEN n > 0 THEN kll_sketch_get_quantile_double(sketch, 0.5D) END"))])
