"""Exact medians by counting selection: histograms over value ranges, narrowed round by round.

No value map and no sort of all values: a round counts the values of each group by
range, finds the range that holds the middle rank, and the next round looks at that
range alone. The first ranges are half powers of two of either sign, so their order is
the order of the values, whatever their magnitude; every later round cuts the range
between the smallest and the largest value left into ``PARTS`` equal ones. The two ends
never share a part, so every round narrows its ranges, by that factor at least; one range of the
first round holds at most 2^52 different doubles, so that five rounds follow at most.

Counts are one row for each group and range that occurs, combined before the
shuffle: a group with a third of all rows costs each task ``PARTS`` rows. The values
that are left after a round are written to the shared folder, so no round reads more
than the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PARTS = 4096
#: Offset of the ranges of positive values; a double's exponent is at least -1074.
_MIDDLE = 5000


def first_range(v: str) -> str:
    """Number of the half power of two that a value is in, as SQL text; ascending with the value, infinities last."""
    size = f"floor(log2(abs({v})) * 2) + {_MIDDLE}"
    return (f"CASE WHEN {v} = 0 THEN 0 WHEN {v} = double('Infinity') THEN {3 * _MIDDLE} "
            f"WHEN {v} = double('-Infinity') THEN -{3 * _MIDDLE} WHEN {v} > 0 THEN {size} ELSE -({size}) END")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chosen(counted: DataFrame, group: list[str]) -> DataFrame:
    """Of the ranges of each wanted rank, the one that holds it: its ends, and how many values lie below it."""
    upto = F.sum("c").over(Window.partitionBy(*group, "rank").orderBy("part"))
    placed = counted.withColumn("_under", F.col("below") + upto - F.col("c"))
    held = (F.col("_under") <= F.col("rank")) & (F.col("rank") < F.col("_under") + F.col("c"))
    return placed.where(held).select(*group, "rank", "lo", "hi", F.col("_under").alias("below"))


def counting_medians(values: DataFrame, group: list[str], value: str = "v", parts: int = PARTS) -> DataFrame:
    """``(*group, n, median)`` of the doubles in ``value`` (null and NaN are no values; infinities are)."""
    group = list(group)
    rows = values.select(*group, F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    held = _stored(rows.withColumn("part", F.expr(f"cast({first_range('v')} as int)")), "median-values")
    first = held.groupBy(*group, "part").agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    sized = first.withColumn("n", F.sum("c").over(Window.partitionBy(*group)))
    ranks = F.array_distinct(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)))
    wanted = sized.withColumn("rank", F.explode(ranks)).withColumn("below", F.lit(0).cast("long"))
    state = _stored(_chosen(wanted, group), "median-state")
    sizes = first.groupBy(*group).agg(F.sum("c").alias("n"))
    found = state.where("lo = hi").select(*group, F.col("lo").alias("v"))
    left = held.drop("part")
    while not (state := state.where("lo < hi")).isEmpty():
        # values in the ranges that are still open; both middle ranks may share one
        open_ = state.groupBy(*group, "lo", "hi").agg(F.collect_list(F.struct("rank", "below")).alias("ranks"))
        left = _stored(left.join(state.select(*group, "lo", "hi").distinct(), group).where("v between lo and hi").select(
            *group, "lo", "hi", "v"), "median-left")
        part = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(parts)), F.lit(parts - 1))
        counted = left.groupBy(*group, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), part.alias("part")).agg(
            F.count("*").alias("c"), F.min("v").alias("_least"), F.max("v").alias("_most"))
        joined = counted.join(open_.withColumnsRenamed({"lo": "_lo", "hi": "_hi"}), [*group, "_lo", "_hi"])
        ranked = joined.select(*group, "part", "c", F.col("_least").alias("lo"), F.col("_most").alias("hi"), F.explode("ranks").alias("_r"))
        state = _stored(_chosen(ranked.select("*", "_r.rank", "_r.below"), group), "median-state")
        found = found.unionByName(state.where("lo = hi").select(*group, F.col("lo").alias("v")))
        left = left.drop("lo", "hi")
    # one value for an odd number of values (or equal middles), else the two in the middle
    middle = found.groupBy(*group).agg(((F.min("v") + F.max("v")) / 2).alias("median"))
    return sizes.join(middle, group)
