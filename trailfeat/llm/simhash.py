"""Near-duplicates by SimHash, linked through pigeonhole blocks.

A text is lower-cased (A-Z), cut into words and word shingles, and each bit of
its 64-bit fingerprint is the majority of that bit over the XXH64 values of the
shingles. Documents whose fingerprints differ in at most ``max_bits`` bits are
linked; a component is what links connect.

Search: the 64 bits are split into ``blocks`` blocks. Two fingerprints within
``max_bits`` bits agree in at least ``blocks - max_bits`` of them, so one key per
choice of that many blocks brings every close pair together; Hamming distance
confirms. Only distinct fingerprints take part. With the default 6 blocks and 4
bits a key holds 21 bits or more; for 10^9 fingerprints and above use 7 or 8
blocks (27 and 32 bits, 35 and 70 keys): results do not depend on the choice.

A key shared by more than ``group_rows`` fingerprints is spread over chunks, and
each pair of chunks is one unit of work, so a unit has a bounded size, no
member is dropped, and no pair of close members is missed. A unit returns links
that span its components (at most one per member), never all its pairs.

Defined cases: null, empty and blank texts have no words and fingerprint zero,
which is linked like any other; with fewer words than a shingle the whole word
sequence is the only shingle; a null doc_id never names a component unless all
ids of the component are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow, row_struct, slices, texts
from .components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCKS = 6
GROUP_ROWS = 4096
#: Keys of crowded groups that may be broadcast (about 20 bytes each); beyond it they are joined by a shuffle.
BROADCAST_KEYS = 500_000
SEED = 42

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a text."""
    parts = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    whole, hash64 = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    ends = ends[-n:] if n > 1 else ends[-1:]
    # bit counts in slices of bounded size, so that a very long text needs little memory
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        spans = zip(starts[at:at + 65_536].tolist(), ends[at:at + 65_536].tolist(), strict=True)
        h = np.array([hash64(whole[i:j], SEED) for i, j in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_BITS[2 * ones > n].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_hash, fp)`` with the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                fp = np.array([fingerprint(t, words) for t in texts(batch.column(2))], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)],
                                                 ["doc_id", "text_hash", "fp"])

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    text = F.col(f"`{text_col}`")
    return map_arrow(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                                 text.alias("text")), run, f"doc_id {kind}, text_hash long, fp long")


def block_keys(fp: Column, blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> Column:
    """An array of keys, one for each choice of ``blocks - max_bits`` blocks: the choice and its masked bits."""
    if blocks <= max_bits:
        raise ValueError("more blocks than bits may differ are needed")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    chosen = [signed(sum(masks[i] for i in c)) for c in combinations(range(blocks), blocks - max_bits)]
    return F.array(*[F.struct(F.lit(i).cast("short").alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits"))
                     for i, m in enumerate(chosen)])


def spanning_links(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links ``(member, smallest of its component)`` of distinct fingerprints under the bit distance."""
    members = np.sort(members)
    bits, out = members.view(np.uint64), []
    rest = np.arange(len(members))
    while len(rest) > 1:
        root, front, rest = rest[0], [rest[0]], rest[1:]
        while front and len(rest):
            near = np.bitwise_count(bits[rest] ^ bits[front.pop()]) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                out += [(int(members[i]), int(members[root])) for i in found]
                front += found.tolist()
    return out


def fingerprint_links(distinct: DataFrame, blocks: int = BLOCKS, max_bits: int = MAX_BITS,
                      group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the fingerprints (column ``fp``) that close pairs connect."""
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), blocks, max_bits)).alias("k")).select("fp", "k.*")
    # the keys of many fingerprints: at most one for every group_rows rows
    crowded = checkpointed(keyed.groupBy("choice", "bits").count().where(F.col("count") > group_rows).select(
        "choice", "bits", F.ceil(F.col("count") / group_rows).cast("int").alias("chunks")))
    keys = crowded.count()
    if keys:
        crowded = F.broadcast(crowded) if keys <= BROADCAST_KEYS else crowded
        keyed = keyed.join(crowded, ["choice", "bits"], "left")
    else:
        keyed = keyed.withColumn("chunks", F.lit(None).cast("int"))
    chunks = F.coalesce("chunks", F.lit(1))
    units = keyed.withColumn("own", F.pmod(F.xxhash64("fp"), chunks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "choice", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    groups = units.groupBy("choice", "bits", "a", "b").agg(F.collect_list("fp").alias("fps")).where(
        F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
            sizes = np.diff(offsets)
            at = offsets[:-1][sizes == 2]
            first, second = values[at], values[at + 1]
            near = np.bitwise_count((first ^ second).view(np.uint64)) <= max_bits
            links = list(zip(first[near].tolist(), second[near].tolist(), strict=True))
            for i in np.flatnonzero(sizes > 2):
                links += spanning_links(values[offsets[i]:offsets[i + 1]], max_bits)
            us, vs = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return map_arrow(groups, run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, blocks: int = BLOCKS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id)`` for every row; the id is the smallest doc_id reachable."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, words))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(classes.select("fp"), blocks, max_bits, group_rows))
    linked = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = linked.select("fp", "root").join(named, "root")
    return prints.join(by_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One whole row of each component: the one with its smallest id.

    Rows that have this id too go; of rows that repeat id and text one stays. A
    row without an id stays only when no row of its component has one.
    """
    found = near_duplicates(docs, id_col, text_col, words, max_bits, blocks)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    kept = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies")).groupBy("root").agg(
        F.min(F.struct(order.alias("order"), F.col("copies").alias("copies"))).alias("kept"))
    kept = checkpointed(kept.select(F.col("kept.order.id").alias("kept_id"), F.col("kept.order.hash").alias("kept_hash"),
                                    F.col("kept.copies").alias("kept_copies")))
    rows = docs.select(row_struct(docs).alias("row"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"))
    joined = rows.join(kept, F.col(f"row.`{id_col}`").eqNullSafe(F.col("kept_id"))
                       & (F.col("hash") == F.col("kept_hash")))
    out = joined.where("kept_copies = 1").select("row.*")
    if not kept.where("kept_copies > 1").isEmpty():
        again = joined.where("kept_copies > 1").groupBy("kept_id", "kept_hash").agg(F.first("row").alias("row"))
        out = out.unionByName(again.select("row.*"))
    return out
