"""Pack token sequences into windows of fixed length by best-fit decreasing.

Every document is tokenized, its end token is added, and it is cut into full
windows and a rest. The rests are packed best-fit decreasing: the longest first,
each into the open window with the least room that still takes it. Packing
depends on lengths only, and there are at most ``window`` of them, so the exact
best-fit-decreasing packing of the *whole* corpus is computed from the counts of
pieces by length (``plan``): a segment tree over remaining capacity finds the
tightest open windows, and equal windows are handled as one run. The plan maps
"the k-th piece of length s" to a window and an offset; ranks within a length
come from windows over ``(length, lane)`` with lanes of bounded size, so no task
and not the driver ever holds all pieces, and one length may hold any share.

Defined cases: a null text counts as empty and is the end token alone; repeated
rows are packed separately; a null doc_id is carried along; an empty table gives
an empty result. Columns other than id and text do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .common import checkpointed, map_arrow, slices, texts

WINDOW = 2048
#: Bytes of pieces of one length that one task ranks: a lane.
LANE_BYTES = 16 << 20
#: What a piece weighs there besides its ids.
ROW_BYTES = 100


class RoomTree:
    """Segment tree over capacities ``0..size``: which capacities have an open window."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.open = [0] * (2 * self.width)

    def add(self, room: int, change: int) -> None:
        node = room + self.width
        while node:
            self.open[node] += change
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of ``least`` or more that has an open window."""
        node = least + self.width
        if self.open[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (pieces by length).

    Rows ``(length, first, pieces, window0, per_window, offset)``: of the pieces
    of this length, those ranked ``first .. first + pieces - 1`` go to windows
    from ``window0`` on, ``per_window`` to each, starting at ``offset``.
    """
    tree, runs = RoomTree(window), {}  # runs: by room, lists of (first window, windows)
    out, made = [], 0

    def put(room: int, first: int, windows: int) -> None:
        if room and windows:
            runs.setdefault(room, []).append((first, windows))
            tree.add(room, 1)

    for length in sorted((s for s in counts if counts[s]), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                # as many new windows as the rest of this length needs
                first, windows, room = made, -(-left // (window // length)), window
                made += windows
            else:
                first, windows = runs[room].pop()
                tree.add(room, -1)
            fits = room // length
            full = min(windows, left // fits)
            rest = left - full * fits if full < windows else 0
            out.append((length, rank, full * fits + rest, first, fits, window - room))
            put(room - fits * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), windows - full - bool(rest))
            rank, left = rank + full * fits + rest, left - full * fits - rest
    return out


def _pieces(tokenizer: str, end_id: int, window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
    end = np.uint32(end_id).astype("<u4").tobytes()

    def kept(part: bytes, id_bytes: int) -> bytes | None:
        if id_bytes in (0, 4):
            return part if id_bytes else None
        return np.frombuffer(part, "<u4").astype("<u2", casting="same_kind").tobytes()

    def run(batches: Iterator[pa.RecordBatch], id_bytes: int) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        if id_bytes == 2 and max(enc.tok.get_vocab_size(), end_id + 1) > 1 << 16:
            raise ValueError("two bytes do not hold every id of this vocabulary")
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    ids = enc.encode(text) + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        part = ids[4 * start:4 * (start + window)]
                        rows.append((doc, start, len(part) // 4, zlib.crc32(part), total, kept(part, id_bytes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return run


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", id_bytes: int = 0) -> DataFrame:
    """The pieces of every document: full windows, then the rest.

    ``ids`` holds their ids, little-endian, in ``id_bytes`` (2 or 4) bytes each; 0 leaves it null.
    """
    if id_bytes not in (0, 2, 4):
        raise ValueError("id_bytes must be 0, 2 or 4")
    run = _pieces(tokenizer, end_id, window)
    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")),
                     lambda batches: run(batches, id_bytes),
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack_pieces(pieces: DataFrame, window: int = WINDOW, id_bytes: int = 0, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``length`` in 1..window, other columns are kept.

    ``id_bytes`` is what the pieces carry for each of their ids, for sizing lanes.
    """
    kept = [c for c in pieces.columns if c != "length"]
    held = checkpointed(pieces.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "length",
                                      F.monotonically_increasing_id().alias("salt")))
    # at most `window` rows reach the driver
    counts = {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}
    lanes = {s: max(1, -(-n * (ROW_BYTES + s * id_bytes) // lane_bytes)) for s, n in counts.items()}
    # bounded by the plan: about two steps for each length, whatever the corpus holds
    by_length = held.sparkSession.createDataFrame(
        [(s, lanes[s], [step[1:] for step in steps]) for s, steps in groupby(plan(counts, window), lambda step: step[0])],
        "length long, lanes long, steps array<struct<first: long, pieces: long, window0: long, per_window: long, at: long>>")
    laned = held.join(F.broadcast(by_length.select("length", "lanes")), "length").withColumn(
        "lane", F.pmod(F.xxhash64("salt"), F.col("lanes")).cast("int"))
    ranked = laned.selectExpr("*", "row_number() over (partition by length, lane order by salt) - 1 as nr")
    per_lane = laned.groupBy("length", "lane").count()
    before = per_lane.selectExpr("length", "lane", "sum(count) over (partition by length order by lane) - count as before")
    ranked = ranked.join(before, ["length", "lane"]).withColumn("rank", F.col("before") + F.col("nr"))
    placed = ranked.join(F.broadcast(by_length.drop("lanes")), "length").withColumn(
        "step", F.expr("get(filter(steps, s -> s.first <= rank and rank < s.first + s.pieces), 0)"))
    inside = F.col("rank") - F.col("step.first")
    return placed.select(
        *[F.col(f"row.`{c}`") for c in kept], "length",
        (F.col("step.window0") + F.floor(inside / F.col("step.per_window"))).cast("long").alias("sequence_id"),
        (F.col("step.at") + (inside % F.col("step.per_window")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", id_bytes: int = 0, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """Every piece with its place: sequence, offset, and (when asked for) its ids."""
    pieces = cut_documents(docs, tokenizer, end_id, window, id_col, text_col, id_bytes)
    return pack_pieces(pieces if id_bytes else pieces.drop("ids"), window, id_bytes, lane_bytes)
