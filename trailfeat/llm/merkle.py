"""Merkle manifest of a dataset: a tree for each source, a tree over their roots, and a proof for every row.

Leaves are ordered within their source, and every ``fan`` consecutive nodes of a
level become one node of the next until one is left, the source's ``subroot``;
the subroots in the order of their sources are the leaves of the tree whose last
node is ``root``. A digest is the lower-case hexadecimal SHA-256 of its inputs,
digests entering as that text.

A level is built by sibling-shift self-joins: a node of slot ``j`` looks up the
slot-zero node of its run by the computed index (``index XOR 1`` in binary trees,
``index - j`` otherwise), an equi-join on ``(tree, index)``, and the slot-zero row
emits the parent. Every source climbs at the same time, so there are about
``log_fan`` of the largest source many levels, and none has more rows than the
one below divided by ``fan`` (plus one for each source). Each level is written to
the shared folder once, so a lost executor costs one level. On the way down the
runs above a node are joined to it, level by level, which gives the path of
every leaf without collecting any tree.

Indices come from one range exchange on ``(source, id, leaf)``: a source with a
third of all rows spans as many ranges as its rows need, and rows repeated in full
are spread by a salt that is drawn at the scan.

Defined cases: a null source is a source of its own, before all others; a null id
comes first in its source; rows that repeat an id are ordered by their leaf, and
rows repeated in full are leaves of their own with equal digests; a null value is
``-`` in a leaf, an empty text ``0:``; texts of any length enter whole; columns
that are no field of the leaf do not matter, whatever their names; an empty table
has no root and gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sequence import global_rank
from ..session import scratch_path
from .common import checkpointed

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: each value as ``-`` if null, else its UTF-8 length, a colon and itself."""
    def written(value: Column) -> Column:
        plain = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))
    return digest(*[written(v) for v in values])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows (source, id, leaf, ...)`` with tree number ``t``, index ``i`` in the tree and its size ``n``."""
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("source", "id", "leaf", "_salt")]
    held = checkpointed(salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt"))
    # the rows lie in order in the partitions of what was written: their number there is partition and place
    held = held.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    # one row for each partition, and one for each source
    spans = held.groupBy("_part", "source").agg(F.count("*").alias("_rows"), F.min("_at").alias("_from"))
    sources = global_rank(spans.groupBy("source").agg(F.min("_from").alias("_first"), F.sum("_rows").alias("n")),
                          ["_first"]).select(F.col("source").alias("_source"), F.col("pos").alias("t"), "n")
    before = spans.selectExpr("_part", "source", "_from",
                              "sum(_rows) over (partition by source order by _part) - _rows as _before")
    placed = before.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("_part").alias("_p"), "_source", "_from", "_before", "t", "n")
    return held.join(placed, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_source"))).select(
        *[F.col(f"`{c}`") for c in rows.columns], "t", (F.col("_before") + F.col("_at") - F.col("_from")).alias("i"), "n")


def runs_of(nodes: DataFrame, fan: int) -> DataFrame:
    """One level: ``(t, run, n, d, up)`` from ``nodes (t, i, n, d)``; ``d`` holds the digests of the run, ``up`` the parent's."""
    slot = F.col("i") % F.lit(fan)
    heads = nodes.where(slot == 0).select("t", "i", "n", F.col("d").alias("d0"))
    for j in range(1, fan):
        sibling = F.col("i").bitwiseXOR(F.lit(1)) if fan == 2 else F.col("i") - F.lit(j)
        shifted = nodes.where(slot == j).select("t", sibling.alias("i"), F.col("d").alias(f"d{j}"))
        heads = heads.join(shifted, ["t", "i"], "left")
    names = [f"d{j}" for j in range(fan)]
    return heads.select("t", F.expr(f"i div {fan}").alias("run"), "n", F.array(*names).alias("d"),
                        digest(F.concat_ws("", *names)).alias("up"))


def _sizes(n: int, fan: int) -> int:
    """How many levels of runs a tree of ``n`` leaves has."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


@dataclass
class Forest:
    """Trees that climbed together: ``levels[k]`` are the runs of level k, ``tops (t, n, d)`` the last nodes."""

    levels: list[DataFrame]
    tops: DataFrame

    def paths(self, leaves: DataFrame, crown: DataFrame, fan: int) -> DataFrame:
        """``leaves (t, i, ...)`` with ``rungs``, the runs from the leaf's own upwards, and the columns of ``crown``.

        ``crown`` has one row for each tree: ``t``, its size ``n``, and the ``rungs`` above its last node.
        """
        rest = [c for c in crown.columns if c not in ("t", "n")]

        def ends(level: int) -> DataFrame:
            """Trees whose last node is on this level."""
            low, high = (0 if level == 0 else fan ** (level - 1)), fan ** level
            return crown.where((F.col("n") > low) & (F.col("n") <= high)).select("t", F.lit(0).cast("long").alias("run"), *rest)

        above = ends(len(self.levels))
        for level in reversed(range(len(self.levels))):
            runs = self.levels[level].select("t", F.col("run").alias("own"), F.expr(f"run div {fan}").alias("run"), "d")
            joined = runs.join(above, ["t", "run"]).select(
                "t", F.col("own").alias("run"),
                *[F.concat(F.array("d"), "rungs").alias("rungs") if c == "rungs" else F.col(c) for c in rest])
            above = joined.unionByName(ends(level))
        return leaves.withColumn("run", F.expr(f"i div {fan}")).join(above, ["t", "run"]).drop("run")


def climb(leaves: DataFrame, fan: int, largest: int) -> Forest:
    """Build all trees of ``leaves (t, i, n, d)``; ``largest`` is the size of the largest."""
    tops, levels, nodes = leaves.where("n = 1").select("t", "n", "d"), [], leaves
    for level in range(_sizes(largest, fan)):
        runs = _stored(runs_of(nodes.where(F.col("n") > fan ** level), fan), f"merkle-{level}")
        levels.append(runs)
        tops = tops.unionByName(runs.where((F.col("n") > fan ** level) & (F.col("n") <= fan ** (level + 1))).select(
            "t", "n", F.col("up").alias("d")))
        # n stays the number of leaves: a tree is done on the level whose runs span them all
        nodes = runs.select("t", F.col("run").alias("i"), "n", F.col("up").alias("d"))
    return Forest(levels, tops)


def manifest(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """``rows (source, id, leaf, ...)`` with ``subroot``, ``root``, ``rungs`` and ``slots``.

    ``rungs`` are the runs on the way from the leaf to the root (digests, null where the
    last run is short), ``slots`` the place of the leaf's ancestor in each of them.
    """
    if fan < 2:
        raise ValueError("fan must be 2 or more")
    held = _stored(numbered(rows), "merkle-leaves")
    sizes = held.where("i = 0").agg(F.max("n").alias("largest"), F.count("*").alias("trees")).first()
    largest, trees = sizes["largest"] or 0, sizes["trees"]
    forest = climb(held.select("t", "i", "n", F.col("leaf").alias("d")), fan, largest)
    subroots = _stored(forest.tops.withColumnRenamed("d", "subroot"), "merkle-subroots")
    upper = climb(subroots.select(F.lit(0).cast("long").alias("t"), F.col("t").alias("i"),
                                  F.lit(trees).cast("long").alias("n"), F.col("subroot").alias("d")), fan, trees)
    top = upper.tops.first()  # one digest
    root = F.lit(top["d"] if top else None).cast("string")
    over = held.sparkSession.range(1).select(F.col("id").alias("t"), F.lit(trees).cast("long").alias("n"),
                                             F.lit([]).cast("array<array<string>>").alias("rungs"))
    crown = upper.paths(subroots.select(F.lit(0).cast("long").alias("t"), F.col("t").alias("i"), F.col("n").alias("size"),
                                        "subroot"), over, fan)
    crown = crown.select(F.col("i").alias("t"), F.col("size").alias("n"), "rungs", "subroot")
    found = forest.paths(held, crown, fan)
    own, powers = F.size("rungs") - F.lit(_sizes(trees, fan)), [fan ** k for k in range(max(1, len(forest.levels), len(upper.levels)))]
    powers = F.array(*[F.lit(p).cast("long") for p in powers])

    def slot(x: Column) -> Column:
        here = F.when(x < own, F.col("i")).otherwise(F.col("t"))
        power = F.get(powers, F.when(x < own, x).otherwise(x - own))
        return F.pmod(F.call_function("div", here, power), F.lit(fan)).cast("int")

    slots = F.transform("rungs", lambda r, x: slot(x))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], "subroot", root.alias("root"), "rungs", slots.alias("slots"))


def siblings(rungs: str = "rungs", slots: str = "slots") -> Column:
    """The digests beside a leaf's path, level by level, left to right, as one text."""
    beside = F.transform(F.col(rungs), lambda r, x: F.array_join(
        F.filter(r, lambda d, j: j != F.get(F.col(slots), x)), ""))
    return F.array_join(beside, "")


def folded(leaf: Column, rungs: str = "rungs", slots: str = "slots") -> Column:
    """The root that ``leaf`` and the siblings of a path lead to."""
    def step(acc: Column, rung: Column) -> Column:
        run = F.transform(rung, lambda d, j: F.when(j == F.get(F.col(slots), acc["x"]), acc["d"]).otherwise(d))
        return F.struct(F.sha2(F.array_join(run, ""), 256).alias("d"), (acc["x"] + 1).alias("x"))
    return F.aggregate(F.col(rungs), F.struct(leaf.alias("d"), F.lit(0).alias("x")), step, lambda acc: acc["d"])


def verified_documents(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """The manifest of ``docs``, and what its proofs say of rows whose line ends were deleted (every other id by CRC)."""
    values = {c: F.col(f"`{c}`") for c in FIELDS}
    changed = {**values, "text": F.replace(values["text"], F.lit("\n"), F.lit(""))}
    tampered = F.pmod(F.crc32(values["doc_id"].cast("string").cast("binary")), F.lit(2)) == 0
    rows = docs.select(
        values["source"].alias("source"), values["doc_id"].alias("id"), leaf_digest(*values.values()).alias("leaf"),
        F.when(tampered & F.contains(values["text"], F.lit("\n")), leaf_digest(*changed.values())).alias("changed"))
    found = manifest(rows, fan)
    back = folded(F.coalesce("changed", "leaf"))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(), 256).alias("proof_sha256"),
                        back.alias("folded_root"), "source").withColumn(
        "verified", F.col("folded_root") == F.col("root"))
