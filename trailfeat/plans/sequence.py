"""Skew-safe ordered scans over keyed rows (position, lags, running sums, first).

The textbook way, ``Window.partitionBy(key).orderBy(...)``, sends every row of
a key to one task. When one key holds a third of a 100 TB table that task never
finishes. Here a key with more than ``rows_per_block`` rows is cut into blocks:

1. One map-side combined count finds these *heavy* keys (at most
   ``n / rows_per_block`` of them), and one ``percentile_approx`` over their rows
   alone gives bounds on the first order column, about one per
   ``rows_per_block`` rows. A row's block is a function of its key and that
   column (a binary search in the bounds), so nothing depends on where a row
   was placed, and a repeated task finds the same block.
2. Windows partitioned by ``(key, block)`` compute the local position, lags,
   running sums and first values: the only exchange of all rows.
3. For heavy keys alone, a small table holds the count, sums, first row and the
   last ``lags`` rows of every block. Counts and sums are combined before the
   shuffle, first and last rows are limited per task before it. The table has at
   most ``2 n / rows_per_block`` rows; it corrects the local values of later blocks.

Everything is one lazy plan: building it runs no job and writes nothing. Without
a heavy key the extra branches are empty. How rows are cut changes only how the
work is spread, never a result.

Keys must not be null (a null key is never cut). The first order column must be a
number, date or timestamp; rows with the same value of it share a block. With
``unique`` (the default) rows with equal ``(key, order)`` are refused with an
error, as their order would be undefined.

Output columns added to the input's columns::

    pos             0-based position of the row within its key
    <c>_lag<j>      value of c, j rows earlier in the same key (NULL if none)
    <c>_cum         running sum of c up to and including the row
    <c>_first       c at the key's first row
    seq_n           number of rows of the key (with_count=True)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLK = "_blk"
#: Rows of one key that one task orders.
ROWS_PER_BLOCK = 4_000_000
#: Bounds per key are taken from this many percentiles; a power of two.
GRID = 4096
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def heavy_bounds(df: DataFrame, keys: list[str], by: str, rows_per_block: int) -> DataFrame:
    """``(keys, _bounds)`` for keys with more than ``rows_per_block`` rows: ascending bounds on ``by``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_block)
    parts = F.least(F.ceil(F.col("_n") / rows_per_block), F.lit(GRID)).cast("int")
    # one text literal: thousands of number literals would slow down every analysis of the plan
    grid = f"cast(split('{','.join(str(i / GRID) for i in range(1, GRID))}', ',') as array<double>)"
    cut = (df.select(*keys, F.col(by).alias("_by")).join(F.broadcast(counts.select(*keys, parts.alias("_parts"))), keys)
           .groupBy(*keys, "_parts").agg(F.expr(f"percentile_approx(_by, {grid}, {8 * GRID})").alias("_g")))
    picked = F.expr(f"transform(sequence(1, greatest(_parts - 1, 1)), i -> _g[cast(i * {GRID} / _parts as int) - 1])")
    return cut.select(*keys, F.array_distinct(picked).alias("_bounds"))


def block_of(by: str) -> Column:
    """Number of bounds at or below ``by`` (0 without bounds), by binary search."""
    steps = ", ".join(str(GRID >> i) for i in range(1, GRID.bit_length()))
    found = (f"aggregate(array({steps}), 0, (lo, s) -> CASE WHEN lo + s <= size(_bounds) "
             f"AND get(_bounds, lo + s - 1) <= `{by}` THEN lo + s ELSE lo END)")
    return F.expr(f"CASE WHEN _bounds IS NULL THEN 0 ELSE {found} END").cast("int")


def sequence(df: DataFrame, keys, order, lag_cols=(), lags: int = 0, sum_cols=(),
             first_cols=(), with_count: bool = False, rows_per_block: int | None = None,
             pos_col: str = "pos", keep_block: bool = False, unique: bool = True) -> DataFrame:
    keys, order = list(keys), list(order)
    lag_cols, sum_cols, first_cols = list(lag_cols), list(sum_cols), list(first_cols)
    lags = max(lags, 1) if lag_cols else 0
    if not isinstance(df.schema[order[0]].dataType, _ORDERED):
        raise TypeError(f"the first order column must be a number, date or timestamp: {order[0]}")
    size = rows_per_block or ROWS_PER_BLOCK
    # at most n / size keys, with n / size bounds (and one per key) in all
    bounds = F.broadcast(heavy_bounds(df, keys, order[0], size))
    heavy = df.join(bounds, keys).withColumn(BLK, block_of(order[0])).drop("_bounds")
    rows = df.join(bounds, keys, "left").withColumn(BLK, block_of(order[0])).drop("_bounds")

    w = Window.partitionBy(*keys, BLK).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local_pos = F.row_number().over(w) - 1
    if unique:
        here = F.struct(*order)
        local_pos = F.when(F.lag(here, 1).over(w).eqNullSafe(here), F.raise_error(F.lit(
            f"rows with equal ({', '.join(keys + order)}): their order is undefined")).cast("int")).otherwise(local_pos)
    sel = [F.col(c) for c in df.columns] + [F.col(BLK), local_pos.cast("long").alias("_lpos")]
    sel += [F.lag(c, j).over(w).alias(f"_llag{j}_{c}") for c in lag_cols for j in range(1, lags + 1)]
    sel += [F.sum(c).over(run).alias(f"_lsum_{c}") for c in sum_cols]
    sel += [F.first(c).over(run).alias(f"_lfirst_{c}") for c in first_cols]
    if with_count:
        sel.append(F.count(F.lit(1)).over(whole).alias("_lcnt"))
    local = rows.select(*sel)

    blocks = heavy.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_bcnt"),
                                           *[F.sum(c).alias(f"_bsum_{c}") for c in sum_cols])
    if first_cols:
        head = heavy.select(*keys, BLK, *[F.col(c).alias(f"_bfirst_{c}") for c in first_cols],
                            F.row_number().over(w).alias("_nr")).where("_nr = 1").drop("_nr")
        blocks = blocks.join(head, [*keys, BLK])
    if lags:
        back = Window.partitionBy(*keys, BLK).orderBy(*[F.desc(c) for c in order])
        last = heavy.select(*keys, BLK, F.struct(F.row_number().over(back).alias("_rev"),
                                                 *[F.col(c) for c in lag_cols]).alias("_row"))
        # at most `lags` rows of a block, oldest first
        tail = last.where(F.col("_row._rev") <= lags).groupBy(*keys, BLK).agg(
            F.reverse(F.array_sort(F.collect_list("_row"))).alias("_tail"))
        blocks = blocks.join(tail, [*keys, BLK])

    kw = Window.partitionBy(*keys).orderBy(BLK)
    before = kw.rowsBetween(Window.unboundedPreceding, -1)
    upto = kw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fix = [*[F.col(k) for k in keys], F.col(BLK), F.coalesce(F.sum("_bcnt").over(before), F.lit(0)).cast("long").alias("_off")]
    if with_count:
        fix.append(F.sum("_bcnt").over(Window.partitionBy(*keys)).alias("_ntot"))
    fix += [F.sum(f"_bsum_{c}").over(before).alias(f"_soff_{c}") for c in sum_cols]
    fix += [F.first(f"_bfirst_{c}").over(upto).alias(f"_gfirst_{c}") for c in first_cols]
    if lags:
        empty = F.slice(F.col("_tail"), 1, 0)
        prev = F.concat(*[F.coalesce(F.lag("_tail", j).over(kw), empty) for j in range(lags, 0, -1)])
        fix.append(F.slice(prev, F.greatest(F.size(prev) - lags + 1, F.lit(1)), lags).alias("_prev"))
    out = local.join(F.broadcast(blocks.select(*fix)), [*keys, BLK], "left")

    res = [F.col(c) for c in df.columns]
    res.append((F.col("_lpos") + F.coalesce("_off", F.lit(0))).alias(pos_col))
    for c in lag_cols:
        for j in range(1, lags + 1):
            earlier = F.get(F.col("_prev"), F.size("_prev") - j + F.col("_lpos").cast("int"))
            res.append(F.when(F.col("_lpos") >= j, F.col(f"_llag{j}_{c}")).otherwise(earlier[c]).alias(f"{c}_lag{j}"))
    res += [(F.col(f"_lsum_{c}") + F.coalesce(f"_soff_{c}", F.lit(0))).alias(f"{c}_cum") for c in sum_cols]
    res += [F.coalesce(f"_gfirst_{c}", f"_lfirst_{c}").alias(f"{c}_first") for c in first_cols]
    if with_count:
        res.append(F.coalesce("_ntot", "_lcnt").cast("long").alias("seq_n"))
    if keep_block:
        res.append(F.col(BLK))            # diagnostics: which block of its key a row is in
    return out.select(*res)


def global_rank(df: DataFrame, order, rows_per_block: int | None = None, unique: bool = True) -> DataFrame:
    """0-based position of every row in the total order ``order`` (adds ``pos``).

    The whole table is a single key, the hottest possible, and is cut into blocks.
    """
    keyed = df.withColumn("_all", F.lit(0))
    return sequence(keyed, ["_all"], order, rows_per_block=rows_per_block, unique=unique).drop("_all")
