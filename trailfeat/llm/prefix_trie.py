"""Trie of conversation prefixes, over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns; its 128-bit digest is chained from
its parent's. Conversations are dealt to shards by ranges of their turn digests,
so that one shard holds neighbours in the trie. Each shard enumerates its distinct
prefix digests and gives them slots by a minimal perfect hash; a looked-up digest
counts only when the digest kept in its slot is the same. Counts are scattered into
flat arrays by slot, and sums over subtrees run through the array of parent slots,
deepest nodes first.

A node that several shards hold (the root, common first turns) is recognised by one
aggregate over all shards' nodes, combined before its shuffle. Every shard learns
the whole counts of such nodes; each node is counted once, by the shard that holds its
smallest member, and the shards' shares of its sums are added up. A shard holds
about ``SHARD_TURNS`` turns, however hot a prefix is: a prefix that a third of all
conversations share spans as many shards as they fill. Ids of equal conversations
that span shards are hashed in ascending order from packets of bounded size.

Defined cases: rows without conv_id belong to no conversation; null role or text is
the empty one; a null turn comes first, and turns of one number follow the
order of their digests; repeated rows are turns of their own; a conversation without
turns ends at the root; an empty table has no nodes. Texts of any length are reduced
to digest and word count at the scan; one conversation's digests are held at a time.
Columns other than conv_id, turn, role and text do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_arrow

#: Turns of a shard, about; and the least number of shards.
SHARD_TURNS = 200_000
LEAST_SHARDS = 48
#: Leading turns by which conversations are put in order.
KEY_TURNS = 32
#: Ids in one packet of equal conversations.
PACKET_IDS = 1000
#: Positions for each key on a level of the hash.
ROOM = 2
ROOT = b"\0" * 16
_NOTHING = hashlib.sha256(b"").hexdigest()


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of ``keys (n, 2)`` that differs from level to level."""
    with np.errstate(over="ignore"):
        h = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(level * 0xD1B54A32D192ED03 & (2 ** 64 - 1))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


class NodeTable:
    """Slots ``0 .. n - 1`` of ``n`` distinct digests, given as rows of two unsigned 64-bit numbers.

    On each level the keys left are hashed to an array; those alone at their
    position get the next slots in the order of positions, the others go on to the next level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        rest, taken = keys, 0
        while len(rest):
            at = (_mixed(rest, len(self.levels)) % np.uint64(ROOM * len(rest))).astype(np.int64)
            alone = np.bincount(at, minlength=ROOM * len(rest)) == 1
            slots = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            self.levels.append(slots)
            taken += int(alone.sum())
            rest = rest[slots[at] < 0]
        self.keys = np.zeros_like(keys)
        self.keys[self._slots(keys)] = keys

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, slots in enumerate(self.levels):
            at = (_mixed(keys[left], level) % np.uint64(len(slots))).astype(np.int64)
            out[left] = slots[at]
            left = left[slots[at] < 0]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that is not in the table."""
        found = self._slots(keys)
        found[found >= 0] = np.where((self.keys[found[found >= 0]] == keys[found >= 0]).all(axis=1), found[found >= 0], -1)
        return found


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


class Shard:
    """The node table of some conversations, and flat arrays by slot.

    ``n``, ``low`` and ``ends``: members, smallest member, and members that end at the node.
    """

    def __init__(self, rows: pa.Table):
        convs = rows.column("conv_id").to_numpy()
        order = np.argsort(convs, kind="stable")
        self.convs = convs[order]
        turns = rows.column("turns").combine_chunks().take(pa.array(order))
        sizes = np.array(turns.value_lengths(), np.int64)
        flat = turns.flatten()
        texts, words = flat.field("d").to_pylist(), flat.field("w").to_numpy(zero_copy_only=False)
        digests, at = [], 0
        for size in sizes.tolist():
            digests.append(ROOT)
            chain = hashlib.sha256()
            for d in texts[at:at + size]:
                chain.update(d)
                digests.append(chain.digest()[:16])
            at += size
        keys = _keys(digests)
        first = np.cumsum(sizes + 1) - sizes - 1  # each conversation's row of the root
        below = np.ones(len(keys), bool)
        below[first] = False
        by_key = np.lexsort((keys[:, 1], keys[:, 0]))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[by_key[1:]] != keys[by_key[:-1]]).any(axis=1)
        self.table = NodeTable(keys[by_key[new]])
        size = len(self.table.keys)
        slots = self.table.slots(keys)
        self.depth, self.parent, self.words = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.depth[slots] = np.arange(len(keys)) - np.repeat(first, sizes + 1)
        self.parent[slots[below]] = slots[np.flatnonzero(below) - 1]
        self.words[slots[below]] = words
        self.n = np.bincount(slots, minlength=size)
        self.low = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(self.low, slots, np.repeat(self.convs, sizes + 1))
        self.last = slots[first + sizes]  # where each conversation ends
        self.ends = np.bincount(self.last, minlength=size)

    def digests(self) -> list[bytes]:
        whole = self.table.keys.tobytes()
        return [whole[k:k + 16] for k in range(0, len(whole), 16)]

    def upward(self, *sums: np.ndarray) -> None:
        """Add every node's values to its parent's, deepest nodes first."""
        order = np.argsort(self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        for nodes in reversed(np.split(order, cuts)[1:]):
            for values in sums:
                np.add.at(values, self.parent[nodes], values[nodes])


def _local(rows: pa.Table) -> pa.Table:
    s = Shard(rows)
    return pa.table({"digest": pa.array(s.digests(), pa.binary()), "shard": pa.array([rows.column("shard")[0].as_py()] * len(s.n), pa.int32()),
                     "n": s.n, "low": s.low, "ends": s.ends})


_OUT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, ids string, first long")


def _whole(rows: pa.Table, shared: pa.Table) -> pa.Table:
    """The shard's share of its nodes, and packets of ids where equal conversations span shards."""
    s = Shard(rows)
    n, low, ends = s.n.copy(), s.low.copy(), s.ends.copy()
    if len(shared):
        at = s.table.slots(_keys(shared.column("digest").to_pylist()))
        for mine, name in ((n, "n"), (low, "low"), (ends, "ends")):
            mine[at] = shared.column(name).to_numpy()
    own = low == s.low
    children = np.bincount(s.parent[own & (s.depth > 0)], minlength=len(n))
    leaves, saved = (own & (n == ends)).astype(np.int64), np.where(own, (n - 1) * s.words, 0)
    s.upward(leaves, saved)
    order = np.argsort(s.last, kind="stable")  # conversations by node, ids ascending
    cuts = np.concatenate([[0], np.cumsum(np.bincount(s.last, minlength=len(n)))])
    hashes, packets = [], []
    for k in range(len(n)):
        if s.ends[k] < ends[k]:
            ids = s.convs[order[cuts[k]:cuts[k + 1]]].tolist()
            packets += [(k, ids[p], ",".join(map(str, ids[p:p + PACKET_IDS]))) for p in range(0, len(ids), PACKET_IDS)]
            hashes.append(None)
        elif s.ends[k]:
            hashes.append(hashlib.sha256(",".join(map(str, s.convs[order[cuts[k]:cuts[k + 1]]].tolist())).encode()).hexdigest())
        else:
            hashes.append(_NOTHING)
    above = np.where(s.parent >= 0, low[s.parent], 0)
    of = np.array([p[0] for p in packets], np.int64)

    def column(values: np.ndarray, blank: bool = True) -> pa.Array:
        return pa.concat_arrays([pa.array(values, pa.int64()), pa.nulls(len(of), pa.int64()) if blank else pa.array(values[of], pa.int64())])

    return pa.table({
        "conv_id": column(low, False), "depth": column(s.depth, False),
        "parent_conv_id": pa.concat_arrays([pa.array(above, pa.int64(), mask=s.parent < 0), pa.nulls(len(of), pa.int64())]),
        "n_convs": column(n), "n_children": column(children), "n_leaves": column(leaves), "saved_tokens": column(saved),
        "ends_sha256": pa.array(hashes + [None] * len(of), pa.string()),
        "ids": pa.array([None] * len(n) + [p[2] for p in packets], pa.string()),
        "first": pa.array([None] * len(n) + [p[1] for p in packets], pa.int64())})


def _hashed(packets: DataFrame) -> DataFrame:
    """``(conv_id, depth, sha)``: the digest of the ids of each node, packet after packet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, chain = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()),
                                               pa.array([chain.hexdigest()])], ["conv_id", "depth", "sha"])
        for batch in batches:
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")), strict=True):
                if (conv, depth) == node:
                    chain.update(b",")
                else:
                    if node is not None:
                        yield done()
                    node, chain = (conv, depth), hashlib.sha256()
                chain.update(ids.encode())
        if node is not None:
            yield done()

    dealt = packets.select("conv_id", "depth", "first", "ids").repartition("conv_id", "depth")
    return map_arrow(dealt.sortWithinPartitions("conv_id", "depth", "first"), run, "conv_id long, depth long, sha string")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: for each conversation its turns in order, as digest ``d`` of role and text, and words ``w``."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    turn = F.col("`turn`").cast("long")
    plain = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    each = conversations.where("conv_id is not null").select(
        F.col("`conv_id`").cast("long").alias("conv_id"), F.struct(
            turn.isNotNull().alias("some"), F.coalesce(turn, F.lit(0)).alias("turn"),
            F.substring(F.unhex(F.sha2(plain, 256)), 1, 16).alias("d"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("w")).alias("t"))
    return each.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts")).select(
        "conv_id", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["w"].alias("w"))).alias("turns"))


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS, least_shards: int = LEAST_SHARDS) -> DataFrame:
    """The nodes of ``paths (conv_id, turns)``, one conversation a row, as ``turns_of`` gives them.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: a node is named by
    its smallest member and its depth.
    """
    held = _stored(paths, "trie-paths")
    total = held.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    shards = max(least_shards, -(-total // shard_turns))
    key = F.transform(F.slice("turns", 1, KEY_TURNS), lambda t: t["d"])
    dealt = held.repartitionByRange(shards, key, F.xxhash64("turns"), F.col("conv_id"))
    rows = _stored(dealt.withColumn("shard", F.spark_partition_id()), "trie-shards")
    local = _stored(rows.groupBy("shard").applyInArrow(_local, "digest binary, shard int, n long, low long, ends long"), "trie-nodes")
    shared = local.groupBy("digest").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("ends").alias("ends"),
                                         F.count("*").alias("shards")).where("shards > 1").drop("shards")
    told = local.select("shard", "digest").join(shared, "digest")
    found = _stored(rows.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(_whole, _OUT), "trie-parts")
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    nodes = found.where("ids is null").groupBy("conv_id", "depth").agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"), *sums, F.max("ends_sha256").alias("ends"))
    return nodes.join(_hashed(found.where("ids is not null")), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", "sha").alias("ends_sha256"))


def rebuilt(paths: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns come from the first conversation of their block of ``every`` ids.

    Conversation c gets the first ``crc32(c) % most`` turns of conversation ``c - c % every`` (none if absent), then
    its own after as many.
    """
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    lead = paths.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("lead"))
    joined = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(lead, "base", "left")
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("lead", none), F.lit(1), taken),
                                             F.slice("turns", taken + 1, F.size("turns"))).alias("turns"))
