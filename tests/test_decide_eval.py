import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from trailfeat.operators import decide as D
from trailfeat.operators import evaluate as EV
from trailfeat.plans.jobs import submission_job
from trailfeat.sources import events as E
from trailfeat.sources import text as TX


def test_auc_matches_spark_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    p = E.predictions(spark, SF_CHECK)
    ours = EV.auc(p, "score", "truth").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="truth",
                                       metricName="areaUnderROC", numBins=0)
    assert abs(ours - ev.evaluate(p)) < 1e-9


def test_auc_at_five_thousand_million_rows(spark):
    """Counts beyond 2^31 squared: the products stay exact."""
    n = 5_000_000_000
    g = spark.createDataFrame([(0.2, n // 2, n), (0.7, n // 2 + 7, n), (float("nan"), 0, 3)], "_s double, _pos long, _cnt long")
    pos, cnt = [n // 2, n // 2 + 7, 0], [n, n, 3]
    below, u2 = 0, 0
    for p, c in zip(pos, cnt):
        u2 += p * (2 * below + (c - p))
        below += c - p
    assert EV.auc_of_counts(g).first().auc == pytest.approx(u2 / 2 / (sum(pos) * below), rel=1e-15)
    assert EV.auc_of_counts(g.where("_s > 5")).first().auc is None
    assert EV.auc_of_counts(spark.createDataFrame([(0.5, 3, 3)], "_s double, _pos long, _cnt long")).first().auc is None


def test_logloss_matches_numpy(spark):
    p = E.predictions(spark, SF_CHECK)
    pdf = p.toPandas()
    s = np.clip(pdf.score.values, 1e-15, 1 - 1e-15)
    y = pdf.truth.values
    exp = -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    assert abs(EV.logloss(p, "score", "truth").first().logloss - exp) < 1e-12


def test_thresholds(spark):
    df = spark.createDataFrame([(1, 0.97, "0.0"), (2, 0.9699, "1.0"), (3, 0.5, "0.00")],
                               "traj_id long, score double, label string")
    assert [r.traj_id for r in D.by_score(df).collect()] == [2, 3]
    assert [r.traj_id for r in D.by_class(df).collect()] == [1]


@pytest.mark.parametrize("kind", ["score", "class"])
def test_submission_job_line_numbers(spark, kind):
    d = tempfile.mkdtemp(prefix="trailfeat-sub-")
    vals = [0.1, 0.99, 0.5, 0.98, 0.2, 0.97, 0.0]
    lines = [f"{i}\t{v}" if kind == "score" else ("0.0" if v < 0.5 else "1.0") for i, v in enumerate(vals)]
    src = os.path.join(d, "pred.txt")
    with open(src, "w") as f:
        f.write("\n".join(lines) + "\n")
    out = os.path.join(d, "out")
    submission_job(spark, src, out, kind=kind)
    got = _submitted(out)
    exp = [i + 1 for i, v in enumerate(vals) if (v < 0.97 if kind == "score" else v < 0.5)]
    assert got == exp


def test_submission_numbering_spans_files_in_order(spark):
    d = tempfile.mkdtemp(prefix="trailfeat-sub2-")
    src = os.path.join(d, "preds")
    os.makedirs(src)
    with open(os.path.join(src, "part-00000"), "w") as f:
        f.write("0.0\n1.0\n0.0\n")
    with open(os.path.join(src, "part-00001"), "w") as f:
        f.write("1.0\n0.0\n")
    out = os.path.join(d, "out")
    submission_job(spark, src, out, kind="class")
    assert _submitted(out) == [1, 3, 5]


def _submitted(out):
    """The lines of a submission, file by file."""
    return [int(v) for f in sorted(os.listdir(out)) if f.startswith("part-") for v in open(os.path.join(out, f))]


def test_line_numbers_over_split_files(spark):
    """A file cut into many splits, and two files: numbers go on in file order."""
    d = tempfile.mkdtemp(prefix="trailfeat-lines-")
    for name, a, b in (("part-00000", 0, 3000), ("part-00001", 3000, 3500)):
        with open(os.path.join(d, name), "w") as f:
            f.writelines(f"line {i:05d} {'x' * (i % 50)}\n" for i in range(a, b))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = TX.line_numbers(TX.read_lines(spark, d)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.ordinal, int(r.value[5:10])) for r in rows) == [(i + 1, i) for i in range(3500)]


def test_score_lines_are_numbers_or_refused(spark):
    d = tempfile.mkdtemp(prefix="trailfeat-bad-")
    with open(os.path.join(d, "p.txt"), "w") as f:
        f.write("a\t0.5\nno tab\nb\t0.1d\nc\tx\nd\t\ne\t 2e-1 \nf\tnan\ng\t0.99\tmore\n")
    with pytest.raises(Exception, match="bad prediction line"):
        submission_job(spark, d, os.path.join(d, "out1"))
    out = os.path.join(d, "out2")
    submission_job(spark, d, out, mode="quarantine")
    assert _submitted(out) == [1, 6]
    bad = {(r.ordinal, r.reason) for r in spark.read.parquet(out + "_quarantine").collect()}
    assert bad == {(2, "no_score"), (3, "bad_score"), (4, "bad_score"), (5, "bad_score")}


def test_join_reports_unmatched_rows(spark):
    p = spark.createDataFrame([(1, 0.5), (2, 0.99)], "traj_id long, score double")
    t = spark.createDataFrame([(2, 10), (3, 11)], "traj_id long, point_count long")
    got = {(r.traj_id, r.score, r.point_count, r.flagged, r.matched) for r in D.join_predictions(p, t).collect()}
    assert got == {(1, 0.5, None, True, "prediction"), (2, 0.99, 10, False, "both"), (3, None, 11, None, "trajectory")}
