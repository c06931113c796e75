"""Reproducible shuffle into shards: a Feistel permutation with cycle walking.

Every row gets a global row number in ``[0, n)``, and a keyed permutation of
``[0, n)`` turns it into a position; ``shard = position mod shards`` and
``slot = position div shards``. Shard sizes differ by one row at most, slots
have no gaps, and (given the row number) both can be computed for any single
row, forwards and backwards, without looking at other rows.

The permutation is a Feistel network over pairs ``(l, r)`` in ``[0, a) x
[0, b)`` whose halves are added modulo ``a`` and ``b`` in turn. ``a * b`` is
chosen at or just above ``n``; positions outside ``[0, n)`` are walked on along
their cycle. As only ``a * b - n`` positions are outside, that many steps are
always enough, so the walk is a bounded native expression.

Row numbers follow the order of ``xxhash64(id)``; ties are ordered by id and
text hash. Counting and numbering use hash ranges of at most about
``ROWS_PER_RANGE`` rows. Rows of an id that alone exceeds the range size are
spread over sub-ranges within that id's own interval of numbers.

Defined cases: null ids are one id; a null text has hash of null, size 1 and
the CRC of the empty string; rows repeated in full are exchangeable and get
different numbers; an empty table gives an empty result. Extra columns are
kept by ``shard_rows`` inside its ``row`` struct, so names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, row_struct

ROWS_PER_RANGE = 50_000
ROUNDS = 8
SEED = 20_240_229


def halves(n: int) -> tuple[int, int]:
    """``(a, b)`` with ``a * b >= n``, both near the square root and few positions to spare."""
    root = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return min(((a, -(-n // a) or 1) for a in range(root, root + min(4 * root, 4096))),
               key=lambda p: (p[0] * p[1] - n, p[0]))


def _network(x: Column, a: int, b: int, seed: int, rounds: int) -> Column:
    # A round takes (l, r, modulus of l, modulus of r): l gets a hash of r added, then the halves swap.
    start = F.struct((x % F.lit(a)).alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a if i % 2 == 0 else b).cast("long").alias("m"))
                      for i in range(rounds)])

    def step(acc: Column, s: Column) -> Column:
        mixed = F.pmod(acc["l"] + F.pmod(F.xxhash64(F.lit(seed), s["i"], acc["r"]), s["m"]), s["m"])
        return F.struct(acc["r"].alias("l"), mixed.alias("r"))

    # After an even number of rounds the halves are back in their own ranges.
    return F.aggregate(steps, start, step, lambda acc: acc["r"] * F.lit(a) + acc["l"])


def permuted(x: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The position in ``[0, n)`` of row number ``x`` (a long column in ``[0, n)``)."""
    if rounds % 2:
        raise ValueError("rounds must be even")
    a, b = halves(n)
    first = _network(x, a, b, seed, rounds)
    if a * b == n:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(a * b - n)), first,
                       lambda acc, _: F.when(acc < F.lit(n), acc).otherwise(_network(acc, a, b, seed, rounds)))


def number_rows(rows: DataFrame, n: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Replace ``(id, tie, row)`` by ``(row, row_number)`` with gapless global numbers.

    ``rows`` is written to the checkpoint folder with a salt for each row, and again sorted
    within its hash ranges, so that the counts and the numbers come from the same rows
    whichever tasks are repeated.
    """
    bits = max(0, math.ceil(math.log2(max(1, n / rows_per_range))))
    span = F.lit(0).cast("long") if bits == 0 else F.shiftright(F.col("h"), 64 - bits)
    # the salt is written with its row: a task that is repeated later deals the rows of a hot id as before
    rows = checkpointed(rows.withColumn("salt", F.monotonically_increasing_id()))
    ranged = rows.withColumn("h", F.xxhash64("id")).withColumn("range", span)
    heavy = (rows.groupBy(F.xxhash64("id").alias("h")).count().where(F.col("count") > rows_per_range)
             .select(span.alias("range"), "h", F.ceil(F.col("count") / rows_per_range).alias("parts"))
             .groupBy("range").agg(F.collect_list(F.struct("h", "parts")).alias("heavy")))
    # part 2j: hashes between the heavy ones; part 2j + 1: heavy hash j, split further by a salt
    ranged = ranged.join(heavy, "range", "left")
    below = F.expr("size(filter(heavy, v -> v.h < h))")
    parts = F.expr("get(filter(heavy, v -> v.h = h), 0).parts")
    ranged = ranged.select(
        "range", "h", "id", "tie", "salt", "row",
        F.when(F.col("heavy").isNull(), 0).otherwise(2 * below + F.when(parts.isNull(), 0).otherwise(1)).alias("part"),
        F.when(F.col("heavy").isNull() | parts.isNull(), 0)
         .otherwise(F.pmod(F.xxhash64("tie", "salt"), parts)).cast("long").alias("sub"))
    group = ["range", "part", "sub"]
    local = checkpointed(ranged.selectExpr(
        *group, "row", "row_number() over (partition by range, part, sub order by h, id, tie, salt) as nr"))
    # one row per range: a bounded table (n / rows_per_range, and two for each heavy id)
    counts = local.groupBy(*group).agg(F.count("*").alias("c"))
    offsets = counts.selectExpr(*group, "sum(c) over (order by range, part, sub) - c as before")
    return (local.join(F.broadcast(offsets), group)
            .select("row", (F.col("before") + F.col("nr") - 1).alias("row_number")))


def shard_rows(df: DataFrame, id_col: str, text_col: str | None = None, shards: int = 16,
               seed: int = SEED, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(row, row_number, shard, slot)`` for every row of ``df``; ``row`` holds all its columns."""
    n = df.count()
    rows = df.select(F.col(f"`{id_col}`").alias("id"),
                     (F.xxhash64(F.col(f"`{text_col}`")) if text_col else F.lit(0)).alias("tie"),
                     row_struct(df).alias("row"))
    numbered = number_rows(rows, n, rows_per_range)
    position = numbered.withColumn("position", permuted(F.col("row_number"), n, seed))
    return position.select("row", "row_number", F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
                           F.floor(F.col("position") / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows of ``shard_rows`` as one folder per shard, sorted by slot within each file."""
    (sharded.select("shard", "slot", "row.*").repartitionByRange("shard", "slot")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = SEED,
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The assignment alone: the texts are reduced to size, CRC and hash before the shuffle."""
    small = docs.select(
        F.col("doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"))
    out = shard_rows(small.withColumnRenamed("text_hash", "tie_text"), "doc_id", "tie_text", shards, seed,
                     rows_per_range)
    return out.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "row_number")
