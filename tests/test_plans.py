"""Plan shape: the properties the scale design relies on, read off the
physical plans."""

import os
import tempfile

from conftest import SF_SMALL
from trailfeat.operators import features as FT
from trailfeat.operators import longform as LF
from trailfeat.operators.parse import good, parse_trajectories
from trailfeat.plans import catalog
from trailfeat.sources import events as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_features_job_has_no_shuffle(spark):
    d = tempfile.mkdtemp(prefix="trailfeat-plan-")
    E.trajectory_lines(spark, SF_SMALL).write.text(os.path.join(d, "in"))
    fm = FT.feature_matrix(good(parse_trajectories(spark.read.text(os.path.join(d, "in")))))
    plan = _plan(fm)
    assert "Exchange" not in plan and "Sort" not in plan


def test_long_form_uses_hash_aggregates_only(spark):
    lf = LF.feature_matrix_long(LF.step_series(E.lagged_points(spark, SF_SMALL, "B")))
    plan = _plan(lf)
    assert "SortAggregate" not in plan
    assert "HashAggregate" in plan


def _ran(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_scan_moves_the_rows_once_and_runs_nothing_early(spark):
    """Building and explaining runs no job; all rows cross one exchange, and without a
    heavy user the other branches hold no rows."""
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    df = catalog.queries()["series_diff_long"](spark, SF_SMALL)
    first = _plan(df)
    assert len(status.getJobIdsForGroup("lazy")) <= 1  # the schema of the table
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "InsertInto" not in first and first.count("Window") >= 1
    final = _ran(df).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(user_id") <= 2  # the counts by user, and the rows
    assert "percentile_approx" not in final


def test_first_last_is_one_aggregate(spark):
    plan = _plan(catalog.queries()["first_last_long"](spark, SF_SMALL))
    assert plan.count("Exchange") == 1 and "Window" not in plan and "SortAggregate" not in plan


def test_scan_reads_only_needed_columns(spark):
    p = E.predictions(spark, SF_SMALL).filter("score < 0.97").select("traj_id")
    plan = _plan(p)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
