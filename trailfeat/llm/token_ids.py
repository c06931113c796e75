"""Token ids in bit-packed files: fixed width, block offsets, random access.

Each id takes ``width`` bits, the least that hold every id of the vocabulary
(including the end id). A file holds the ids of consecutive documents:

====================  ==================================================
``TIDS``              magic, 4 bytes
blocks                ids, least significant bit first, each from a new byte
u64 x blocks          byte offset of each block, from the start of the file
i64 x documents       document ids, and after them a bitmap of the null ones
u8 x ceil(docs / 8)   (bit set: the id is null)
u64 x (documents + 1) first id of each document in the file, then the total
six u64               width, ids per block, ids, blocks, documents, bucket
``TIDS``              magic again
====================  ==================================================

All numbers are little-endian. A block can be unpacked by itself, so any range
of ids is read from the blocks that hold it; a file is written block by block.

Documents are dealt to buckets by bounds on the document id (approximate
percentiles of that column alone), tokenized after their range is known,
packed, sorted within their bucket and written, one or more files for each
bucket, through ``pyarrow.fs`` under the shared folder. A file is written under
a name of its attempt and then moved to a name that only its place determines,
so a repeated task replaces it by the same bytes. Files are read back through
Spark's ``binaryFile`` source.

Defined cases: a null or empty text is the end id alone; null ids come first;
rows that repeat an id follow one another, ordered by text hash (an id with very
many rows is spread over several buckets); an empty table writes no file.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .bpe import encoder, release
from .common import checkpointed, map_arrow, slices, texts

MAGIC = b"TIDS"
BLOCK_IDS = 65_536
FILE_IDS = 8 << 20
BUCKET_ROWS = 20_000
MAX_BUCKETS = 1 << 16


def width_of(vocabulary: int) -> int:
    """Bits that hold ``0 .. vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits for each id, least significant first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for at in range(0, len(ids), BLOCK_IDS):  # multiples of 8 ids end on a byte
        part = np.ascontiguousarray(ids[at:at + BLOCK_IDS].astype("<u4")).view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(part, axis=1, count=width, bitorder="little"), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes | memoryview, width: int, count: int) -> np.ndarray:
    """The inverse of ``pack``: ``count`` ids."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=width * count, bitorder="little").reshape(count, width)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class FileWriter:
    """Writes one file to a binary stream, holding one block of ids and the index of documents."""

    def __init__(self, out: BinaryIO, width: int, bucket: int = 0, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.bucket, self.block_ids = out, width, bucket, block_ids
        self.docs: list[int | None] = []
        self.starts, self.offsets = [0], []
        self.held: list[np.ndarray] = []
        self.held_ids, self.at = 0, 4
        out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= self.block_ids:
            whole = np.concatenate(self.held)
            full = len(whole) // self.block_ids * self.block_ids
            for k in range(0, full, self.block_ids):
                self._block(whole[k:k + self.block_ids])
            self.held, self.held_ids = [whole[full:]], len(whole) - full

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.held_ids:
            self._block(np.concatenate(self.held))
        null = np.packbits(np.array([d is None for d in self.docs], np.uint8), bitorder="little")
        for numbers in (np.array(self.offsets, "<u8"), np.array([d if d is not None else 0 for d in self.docs], "<i8"),
                        null, np.array(self.starts, "<u8"),
                        np.array([self.width, self.block_ids, self.starts[-1], len(self.offsets), len(self.docs),
                                  self.bucket], "<u8")):
            self.out.write(numbers.tobytes())
        self.out.write(MAGIC)


class TokenFile:
    """Reads a file's bytes: documents, and any range of ids."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if len(data) < 56 or bytes(data[:4]) != MAGIC or bytes(data[-4:]) != MAGIC:
            raise ValueError("not a whole token file")
        self.data, tail = data, len(data) - 52
        self.width, self.block_ids, self.total, blocks, docs, self.bucket = np.frombuffer(data, "<u8", 6, tail).tolist()
        at = tail - 8 * (docs + 1)
        self.starts = np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64)
        at -= -(-docs // 8)
        self.null = np.unpackbits(np.frombuffer(data, np.uint8, -(-docs // 8), at), bitorder="little")[:docs].astype(bool)
        at -= 8 * docs
        self.docs = np.frombuffer(data, "<i8", docs, at)
        self.offsets = np.frombuffer(data, "<u8", blocks, at - 8 * blocks)

    def block(self, k: int) -> np.ndarray:
        count = min(self.block_ids, self.total - k * self.block_ids)
        return unpack(self.data[int(self.offsets[k]):int(self.offsets[k]) + -(-count * self.width // 8)], self.width, count)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start .. stop - 1`` of the file, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return got[start - first * self.block_ids:stop - first * self.block_ids]


def _store(folder: str):
    """The file system of a URI or path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def _writer(folder: str, tokenizer: str, end_id: int, width: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        store, root = _store(folder)
        rows, now, stream, name, own = [], None, None, "", ""

        def close() -> None:
            now.close()
            stream.close()
            if store.get_file_info(f"{root}/{name}").type.name != "NotFound":
                store.delete_file(f"{root}/{name}")  # from an earlier attempt: the same bytes
            store.move(own, f"{root}/{name}")
            rows.append((name, now.bucket, part, len(now.docs), now.starts[-1]))

        part = 0
        for batch in batches:
            for bucket, doc, n, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if now is not None and (bucket != now.bucket or now.starts[-1] >= file_ids):
                    close()
                    part = part + 1 if bucket == now.bucket else 0
                    now = None
                if now is None:
                    name = f"{bucket:08d}-{part:06d}.tids"
                    own = f"{root}/_{name}.{uuid.uuid4().hex}"
                    stream = store.open_output_stream(own)
                    now = FileWriter(stream, width, bucket)
                now.add(doc, unpack(data, width, n))
        if now is not None:
            close()
        names = ["file", "bucket", "part", "docs", "ids"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.uint32(end_id).astype("<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, 3, 4 << 20):
                ids = [np.frombuffer(enc.encode(t) + end, "<u4") for t in texts(batch.column(3))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array([len(i) for i in ids], pa.int64()),
                     pa.array([pack(i, width) for i in ids], pa.binary())], ["bucket", "doc_id", "tie", "n", "packed"])

    return tokens, run


def bounds_below(bounds: list[int], how: str) -> Column:
    """How many of the ascending ``bounds`` are below (``<``) or at most (``<=``) ``doc_id``, by binary search."""
    if not bounds:
        return F.lit(0)
    top = 1 << (len(bounds).bit_length() - 1)
    steps = ", ".join(str(top >> i) for i in range(top.bit_length()))
    # one text literal, folded to an array once
    limits = f"cast(split('{','.join(map(str, bounds))}', ',') as array<bigint>)"
    return F.expr(f"aggregate(array({steps}), 0, (lo, s) -> CASE WHEN lo + s <= {len(bounds)} "
                  f"AND get({limits}, lo + s - 1) {how} doc_id THEN lo + s ELSE lo END)")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS,
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Write all documents in ascending id order; returns the files: ``(file, bucket, part, docs, ids, before)``.

    ``before`` is the number of ids in all files before. ``folder`` is a URI (or
    a path) that executors and driver share; it need not exist.
    """
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    width = width_of(max(vocabulary, end_id + 1))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    buckets = max(1, min(MAX_BUCKETS, -(-rows.count() // bucket_rows)))
    # at most MAX_BUCKETS bounds reach the driver
    wanted = f"cast(split('{','.join(str(i / buckets) for i in range(1, buckets))}', ',') as array<double>)"
    found = rows.agg(F.expr(f"percentile_approx(doc_id, {wanted}, {10 * buckets})")).first()[0] if buckets > 1 else None
    bounds = found or []
    # bounds below the id, and as many buckets more as bounds repeat it: an id that fills several is spread over them
    below, upto = bounds_below(bounds, "<"), bounds_below(bounds, "<=")
    equal = upto - below
    nulls = rows.where("doc_id is null").count()
    null_parts = max(1, -(-nulls // bucket_rows))
    dealt = rows.withColumn("tie", F.xxhash64("text")).withColumn("salt", F.monotonically_increasing_id())
    mixed = F.xxhash64("tie", "salt")
    bucket = F.when(F.col("doc_id").isNull(), F.pmod(mixed, F.lit(null_parts))).otherwise(
        F.lit(null_parts) + below + F.pmod(mixed, F.greatest(equal, F.lit(1))))
    tokens, run = _writer(folder, tokenizer, end_id, width, file_ids)
    kind = "bucket long, doc_id long, tie long, n long, packed binary"
    packed = map_arrow(dealt.select(bucket.cast("long").alias("bucket"), "doc_id", "tie", "text"), tokens, kind)
    parts = max(buckets + null_parts, 1)
    # a bucket is a partition: hashing the numbers would leave some tasks empty and give others several buckets
    sorted_rows = packed.repartitionById(parts, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "doc_id", "tie", "n").select(
        "bucket", "doc_id", "n", "packed")
    files = checkpointed(map_arrow(sorted_rows, run, "file string, bucket long, part long, docs long, ids long"))
    # one row per file
    return files.selectExpr("*", "sum(ids) over (order by bucket, part) - ids as before")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """``(file, doc_id, start, n_tokens, ids_crc32, ids)`` for every document.

    ``start`` counts from the file's first id; ``ids`` (little-endian unsigned
    32-bit) is null without ``with_ids``.
    """
    names = ["file", "doc_id", "start", "n_tokens", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for i in range(batch.num_rows):
                name, tf = batch.column(0)[i].as_py(), TokenFile(batch.column(1)[i].as_buffer())
                for at in range(0, len(tf.docs), 500):
                    begin = tf.starts[at:at + 501]
                    whole = tf.ids(int(begin[0]), int(begin[-1]))
                    cuts, n = begin - begin[0], len(begin) - 1
                    ids = [whole[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * n), pa.array(tf.docs[at:at + n], mask=tf.null[at:at + n]),
                        pa.array(begin[:-1]), pa.array(np.diff(begin)), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(ids if with_ids else [None] * n, pa.binary())], names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*.tids").load(folder)
    return map_arrow(found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"), run,
                     "file string, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_file_rows(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int) -> DataFrame:
    """Write the files under the shared folder, read them back, and describe every document."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    files = write_token_files(docs, folder, tokenizer, vocabulary, end_id)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = read_token_files(spark, folder, with_ids=False).drop("ids")
    return rows.join(F.broadcast(files.select("file", "before")), "file").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
