import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trailfeat.operators import model as M
from trailfeat.operators.features import feature_matrix
from trailfeat.operators.parse import good, parse_trajectories
from trailfeat.plans.jobs import features_job
from trailfeat.sources import events as E
from trailfeat.streaming.feature_stream import start_feature_stream


def test_gbt_train_predict(spark):
    fm = feature_matrix(good(parse_trajectories(E.trajectory_lines(spark, SF_SMALL))))
    mdl = M.fit(fm, rounds=3, max_depth=4)
    pred = M.predict(mdl, fm)
    rows = pred.collect()
    assert len(rows) == fm.count() and all(0.0 <= r.score <= 1.0 for r in rows)
    imp = M.feature_importance(fm, model=mdl)
    assert imp.count() == 69 and abs(sum(r.importance for r in imp.collect()) - 1.0) < 1e-6
    d = tempfile.mkdtemp(prefix="trailfeat-model-")
    M.dump(mdl, os.path.join(d, "gbt"))
    trees = [r.value for r in spark.read.text(os.path.join(d, "gbt_trees")).collect()]
    assert any("Tree 0" in t for t in trees) and os.path.isdir(os.path.join(d, "gbt"))


def test_stream_equals_batch_and_job(spark):
    d = tempfile.mkdtemp(prefix="trailfeat-stream-")
    src = os.path.join(d, "in")
    E.trajectory_lines(spark, SF_SMALL).write.text(src)
    for _ in range(2):  # a restart goes on where the first start stopped, and repeats nothing
        for q in start_feature_stream(spark, src, os.path.join(d, "out"), os.path.join(d, "ckpt"),
                                      os.path.join(d, "bad"), available_now=True):
            q.awaitTermination(300)
    with pytest.raises(ValueError):
        start_feature_stream(spark, src, os.path.join(d, "out"), "", os.path.join(d, "bad"))
    streamed = spark.read.parquet(os.path.join(d, "out"))
    counts = features_job(spark, src, os.path.join(d, "batch"), quarantine_path=os.path.join(d, "bad2"), with_speed_median=False)
    batch = spark.read.parquet(os.path.join(d, "batch"))
    assert counts["trajectories"] == batch.count() == streamed.count()
    assert streamed.exceptAll(batch).count() == 0


def test_features_job_counts_and_quarantine(spark):
    d = tempfile.mkdtemp(prefix="trailfeat-job-")
    src = os.path.join(d, "in")
    lines = E.trajectory_lines(spark, SF_SMALL, corrupt=True)
    lines.write.text(src)
    counts = features_job(spark, src, os.path.join(d, "out"))
    bad = spark.read.parquet(os.path.join(d, "out_quarantine"))  # never dropped silently
    assert counts["lines"] == lines.count()
    assert counts["quarantined"] == bad.count() > 0
    assert counts["trajectories"] == spark.read.parquet(os.path.join(d, "out")).count()
    assert {r.reason for r in bad.collect()} == {"bad_point"}


def test_point_features_job_equals_text_job(spark):
    from trailfeat.operators.parse import explode_points
    from trailfeat.plans.jobs import point_features_job
    d = tempfile.mkdtemp(prefix="trailfeat-pts-")
    tr = E.calendar_trajectories(spark, SF_SMALL)
    explode_points(tr, keep=("traj_id", "aim", "label")).select(
        "traj_id", "pos", "x", "y", "t", F.col("aim.ax").alias("ax"), F.col("aim.ay").alias("ay"),
        "label").write.parquet(os.path.join(d, "pts"))
    point_features_job(spark, os.path.join(d, "pts"), os.path.join(d, "long"))
    long_fm = spark.read.parquet(os.path.join(d, "long"))
    arr = feature_matrix(tr)
    cols = ["traj_id", "point_count", "backtrack_count", "x_median", "log_angle_diff_min", "aim_angle"]
    a = {r.traj_id: r for r in arr.select(*cols).collect()}
    b = {r.traj_id: r for r in long_fm.select(*cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in cols[1:]:
            assert abs(a[k][c] - b[k][c]) <= 1e-9 * max(1.0, abs(a[k][c])), (k, c)


def test_train_job_writes_and_reports(spark):
    from trailfeat.plans.jobs import train_job
    d = tempfile.mkdtemp(prefix="trailfeat-train-")
    fm = feature_matrix(good(parse_trajectories(E.trajectory_lines(spark, SF_SMALL))))
    fm.write.parquet(os.path.join(d, "train"))
    fm.drop("label").write.parquet(os.path.join(d, "score"))
    m = train_job(spark, os.path.join(d, "train"), os.path.join(d, "score"), os.path.join(d, "pred"),
                  model_path=os.path.join(d, "model"), rounds=3, max_depth=4)
    assert 0.0 <= m["auc"] <= 1.0 and m["logloss"] > 0
    assert spark.read.parquet(os.path.join(d, "pred")).count() == fm.count()
    assert spark.read.parquet(os.path.join(d, "model_feature_weights")).count() == 69


def test_training_takes_nan_and_infinity(spark):
    """Numbers the parser accepts (nan, inf) reach the trainer as finite values."""
    lines = [f"t{i} {'nan' if i % 5 == 0 else i},{i % 3},{i};{'inf' if i % 7 == 0 else 2 * i},1,{i + 2}; 5,5 {i % 2}" for i in range(24)]
    fm = feature_matrix(good(parse_trajectories(spark.createDataFrame([(x,) for x in lines], "value string"))),
                        with_speed_median=True)
    assert fm.count() == 24
    rows = M.train_predict(fm, rounds=2, max_depth=3).collect()
    assert len(rows) == 24 and all(0.0 <= r.score <= 1.0 for r in rows)


def test_repeated_ids_count_once_each(spark):
    """Training metrics are taken over the rows themselves, whatever their ids."""
    from trailfeat.plans.jobs import train_job
    d = tempfile.mkdtemp(prefix="trailfeat-rep-")
    fm = feature_matrix(good(parse_trajectories(E.trajectory_lines(spark, SF_SMALL))), with_speed_median=True)
    fm = fm.withColumn("traj_id", F.lit("same"))
    fm.write.parquet(os.path.join(d, "train"))
    m = train_job(spark, os.path.join(d, "train"), os.path.join(d, "train"), os.path.join(d, "pred"), rounds=2, max_depth=3)
    mdl = M.fit(spark.read.parquet(os.path.join(d, "train")), rounds=2, max_depth=3)
    assert M.predict(mdl, fm, keep=("label",)).count() == fm.count()
    assert 0.0 <= m["auc"] <= 1.0


def test_bound_on_training_rows(spark):
    fm = feature_matrix(good(parse_trajectories(E.trajectory_lines(spark, SF_SMALL))))
    assert M.fit(fm, max_rows=30, rounds=1, max_depth=2).numFeatures == 69


def test_point_table_quarantine(spark):
    from trailfeat.plans.jobs import point_features_job
    d = tempfile.mkdtemp(prefix="trailfeat-ptq-")
    rows = [("a", 0, 1.0, "1"), ("a", 1, None, "1"), (None, 0, 1.0, "1"), ("b", 0, 1.0, "1"), ("c", 0, 1.0, "1"), ("c", 1, 1.0, "0")]
    spark.createDataFrame(rows, "traj_id string, pos long, x double, label string").select(
        "*", F.lit(0.0).alias("y"), F.col("pos").cast("double").alias("t"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay")
    ).write.parquet(os.path.join(d, "pts"))
    counts = point_features_job(spark, os.path.join(d, "pts"), os.path.join(d, "out"))
    bad = {(r.traj_id, r.reason) for r in spark.read.parquet(os.path.join(d, "out_quarantine")).collect()}
    assert bad == {("a", "bad_point"), ("c", "varying_constants"), (None, "no_id")}
    assert [r.traj_id for r in spark.read.parquet(os.path.join(d, "out")).collect()] == ["b"]
    assert counts == {"trajectories": 1, "quarantined": 3}


def test_text_to_submission(spark):
    """Lines with a bad one in the middle -> features -> model -> submission by id."""
    from trailfeat.plans.jobs import submission_job, train_job
    d = tempfile.mkdtemp(prefix="trailfeat-chain-")
    lines = [f"{i} " + ";".join(f"{j},{j % 2},{3 * j}" for j in range(3 + 9 * (i % 2))) + f"; 5,5 {i % 2}" for i in range(40)]
    lines[17] = "17 0,a,0; 5,5 1"
    os.makedirs(os.path.join(d, "in"))
    with open(os.path.join(d, "in", "t.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    counts = features_job(spark, os.path.join(d, "in"), os.path.join(d, "fm"))
    assert counts["quarantined"] == 1 and "log_speed_median" in spark.read.parquet(os.path.join(d, "fm")).columns
    train_job(spark, os.path.join(d, "fm"), os.path.join(d, "fm"), os.path.join(d, "pred"), rounds=2, max_depth=2)
    submission_job(spark, os.path.join(d, "pred"), os.path.join(d, "out"), kind="table", threshold=0.5)
    got = [v.strip() for f in sorted(os.listdir(os.path.join(d, "out"))) if f.startswith("part-")
           for v in open(os.path.join(d, "out", f))]
    assert got == sorted(str(i) for i in range(0, 40, 2))
