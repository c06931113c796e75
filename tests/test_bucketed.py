"""Bucketed tables: the join exchanges nothing and gives what the plain join gives."""

import tempfile
import uuid

from pyspark.sql import functions as F

from trailfeat.operators.decide import join_predictions
from trailfeat.sources.bucketed import buckets_for, join_bucketed, write_bucketed


def tables(spark, preds, trajs, buckets):
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (preds, trajs)):
        assert write_bucketed(df, name, buckets=buckets, path=tempfile.mkdtemp(prefix="trailfeat-bucket-") + "/t") == buckets
    return names


def sides(spark):
    preds = spark.range(1000).select((F.col("id") * 3).alias("traj_id"), (F.col("id") / 1000).alias("score"))
    trajs = spark.range(1500).select((F.col("id") * 2).alias("traj_id"), F.col("id").alias("point_count"))
    lone = spark.range(2).select(F.lit(None).cast("long").alias("traj_id"), F.lit(0.5).alias("score"))
    return preds.unionByName(lone), trajs


def test_same_as_the_plain_join(spark):
    preds, trajs = sides(spark)
    names = tables(spark, preds, trajs, 8)
    key = lambda r: tuple(str(v) for v in r)
    got = sorted(join_bucketed(spark, *names).collect(), key=key)
    assert got == sorted(join_predictions(preds, trajs).collect(), key=key) and len(got) == 2002


def test_no_exchange(spark):
    names = tables(spark, *sides(spark), 8)
    plan = join_bucketed(spark, *names)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" in plan
    day = sides(spark)[0].withColumn("score", F.lit(0.1))  # a new day of predictions meets the old trajectories
    other = f"t_{uuid.uuid4().hex}"
    write_bucketed(day, other, buckets=8, path=tempfile.mkdtemp(prefix="trailfeat-bucket-") + "/t")
    assert "Exchange" not in join_bucketed(spark, other, names[1])._jdf.queryExecution().executedPlan().toString()


def test_number_of_buckets_grows_with_the_table():
    assert [buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41, 1000)] == [1, 1, 1, 2, 2, 4, 4, 8, 128]
