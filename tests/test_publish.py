"""Outputs that change all at once: a failing job leaves the former one, a repeated one publishes nothing new."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from trailfeat.plans.jobs import submission_job
from trailfeat.sources.publish import manifests, publish, read_published, sweep


@pytest.fixture()
def out():
    return os.path.join(tempfile.mkdtemp(prefix="trailfeat-publish-"), "out")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_versions(spark, out):
    with pytest.raises(FileNotFoundError):
        read_published(spark, out)
    assert publish(spark.range(5), out) == 1 and publish(spark.range(3), out) == 2
    assert ids(read_published(spark, out)) == [0, 1, 2] and ids(read_published(spark, out, 1)) == [0, 1, 2, 3, 4]
    with pytest.raises(FileNotFoundError):
        read_published(spark, out, 7)


def test_failing_task_leaves_the_former_output(spark, out):
    publish(spark.range(5), out)
    for at in (0, 17, 99):  # some tasks end before the failing one does
        bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == at, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
        with pytest.raises(Exception, match="lost"):
            publish(bad, out)
        assert ids(read_published(spark, out)) == [0, 1, 2, 3, 4] and len(manifests(spark, out)) == 1


def test_repeated_job_publishes_once(spark, out):
    assert publish(spark.range(5), out, job="monday") == publish(spark.range(9), out, job="monday") == 1
    assert publish(spark.range(2), out, job="tuesday") == 2 and publish(spark.range(9), out, job="monday") == 1
    assert ids(read_published(spark, out)) == [0, 1]


def test_two_writers_get_two_versions(spark, out, monkeypatch):
    """A writer that was overtaken between its data and its manifest takes the next version."""
    from trailfeat.sources import publish as module
    publish(spark.range(1), out)
    real, overtaken = module._announce, []

    def late(*args):
        if not overtaken:
            overtaken.append(True)
            publish(spark.range(2), out)
        return real(*args)
    monkeypatch.setattr(module, "_announce", late)
    assert publish(spark.range(3), out) == 3
    assert [m["version"] for m in manifests(spark, out)] == [1, 2, 3]
    assert ids(read_published(spark, out)) == [0, 1, 2] and ids(read_published(spark, out, 2)) == [0, 1]


def test_sweep_keeps_what_is_read(spark, out):
    for n in (1, 2, 3):
        publish(spark.range(n), out)
    with pytest.raises(Exception, match="lost"):
        publish(spark.range(4).select(F.raise_error(F.lit("lost"))), out)
    assert sweep(spark, out) == 2  # the failed job's folder is young
    assert ids(read_published(spark, out)) == [0, 1, 2] and len(manifests(spark, out)) == 1
    sweep(spark, out, min_age_ms=-1)
    assert len(os.listdir(os.path.join(out, "data"))) == 1
    assert publish(spark.range(6), out) == 4


def test_empty_output_keeps_its_schema(spark, out):
    publish(spark.range(5).where("id > 9"), out)
    got = read_published(spark, out)
    assert got.columns == ["id"] and got.count() == 0


def test_submission_that_fails_leaves_the_former_one(spark, out):
    src = tempfile.mkdtemp(prefix="trailfeat-pred-")
    for name, lines in (("good", "a\t0.1\nb\t0.99\nc\t0.2\n"), ("bad", "a\t0.1\nb\tnothing\n")):
        with open(os.path.join(src, name), "w") as f:
            f.write(lines)
    submission_job(spark, os.path.join(src, "good"), out, sink_mode="publish")
    with pytest.raises(Exception, match="bad_score"):
        submission_job(spark, os.path.join(src, "bad"), out, sink_mode="publish")
    assert [r.value for r in read_published(spark, out).collect()] == ["1", "3"]
