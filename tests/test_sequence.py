"""The blocked ordered scan equals plain per-key windows, including a hot key
spread over many blocks and blocks holding a single row."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trailfeat.plans.sequence import global_rank, sequence


def _data(spark):
    rnd = random.Random(7)
    rows = [(7, i, rnd.random()) for i in range(2500)]                  # hot key
    for k in range(30):
        rows += [(100 + k, i, rnd.random()) for i in range(rnd.randint(1, 25))]
    return spark.createDataFrame(rows, "k long, o long, v double")


def test_sequence_matches_windows(spark):
    df = _data(spark)
    for size in (4_000_000, 200, 7):
        s = sequence(df, ["k"], ["o"], lag_cols=["v"], lags=2, sum_cols=["v"],
                     first_cols=["v"], with_count=True, rows_per_block=size)
        w = Window.partitionBy("k").orderBy("o")
        ref = df.select("k", "o", (F.row_number().over(w) - 1).alias("p"),
                        F.lag("v", 1).over(w).alias("l1"), F.lag("v", 2).over(w).alias("l2"),
                        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                        F.first("v").over(w).alias("f"),
                        F.count("*").over(Window.partitionBy("k")).alias("n"))
        j = s.join(ref, ["k", "o"])
        bad = j.filter((F.col("pos") != F.col("p")) | ~F.col("v_lag1").eqNullSafe(F.col("l1"))
                       | ~F.col("v_lag2").eqNullSafe(F.col("l2"))
                       | (F.abs(F.col("v_cum") - F.col("c")) > 1e-9)
                       | (F.col("v_first") != F.col("f")) | (F.col("seq_n") != F.col("n")))
        assert s.count() == df.count() and bad.count() == 0, size


def test_global_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("x"))
    r = global_rank(df, ["x"], rows_per_block=500)
    assert r.filter(F.col("pos") != F.col("x")).count() == 0


def test_single_row_blocks(spark):
    """Blocks of one or two rows: lag 2 must reach back across several blocks."""
    rows = [(1, i, float(i * i)) for i in range(60)] + [(2, i, -float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    s = sequence(df, ["k"], ["o"], lag_cols=["v"], lags=2, sum_cols=["v"], first_cols=["v"],
                 with_count=True, rows_per_block=1)
    got = {(r.k, r.o): r for r in s.collect()}
    for k, o, v in rows:
        r = got[(k, o)]
        prev = [vv for kk, oo, vv in rows if kk == k and oo < o]
        assert r.pos == len(prev)
        assert r.v_lag1 == (prev[-1] if prev else None)
        assert r.v_lag2 == (prev[-2] if len(prev) > 1 else None)
        assert r.v_cum == sum(prev) + v and r.seq_n == sum(1 for x in rows if x[0] == k)


def test_hot_key_is_spread_evenly(spark):
    """One key with two thirds of all rows, clustered in its order: no block is much
    larger than asked for, and the hot key spans many blocks."""
    n = 60000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        F.pow(F.col("id").cast("double"), F.lit(3.0)).alias("o"), F.rand(5).alias("v"))
    s = sequence(df, ["k"], ["o"], lag_cols=["v"], lags=1, rows_per_block=n // 16, keep_block=True)
    sizes = [r["count"] for r in s.groupBy("k", "_blk").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 1.2 * n / 16
    assert s.where("k = 0").select("_blk").distinct().count() >= 10


def test_equal_orders_are_refused(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 5, 2.0), (2, 5, 3.0)], "k long, o long, v double")
    with pytest.raises(Exception, match="equal"):
        sequence(df, ["k"], ["o"], lag_cols=["v"]).collect()
    assert sequence(df.where("v < 3"), ["k"], ["o"], unique=False).count() == 2
    with pytest.raises(TypeError):
        sequence(df.withColumn("o", F.col("o").cast("string")), ["k"], ["o"])


def test_null_and_nan_orders(spark):
    nan = float("nan")
    rows = [(1, None, 0)] + [(1, float(i), i + 1) for i in range(300)] + [(1, nan, 301)]
    df = spark.createDataFrame(rows, "k long, o double, p long")
    got = sequence(df, ["k"], ["o"], rows_per_block=10).collect()
    assert len(got) == 302 and all(r["pos"] == r["p"] for r in got)
